"""Folds, labelled documents and exact ranks of their scores, shared by the classifiers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import running_totals


def held_out() -> Column:
    """True where crc32 of the id as text is 0 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_rows(labels: DataFrame, columns: list[str]) -> DataFrame:
    """The documents outside the held-out fold that have all of ``columns``.

    Rows that repeat an id count once, with their largest label.
    """
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(c).cast("int").alias(c) for c in columns]).dropna()
    return rows.where(~held_out()).groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns])


def labelled_sample(labels: DataFrame, columns: list[str], bound: int) -> DataFrame:
    """At most ``bound`` of these documents, in the order of a hash of the id. The bound makes the result safe to broadcast."""
    return labelled_rows(labels, columns).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def ranked(rows: DataFrame, group: list[str], value: str, rank: Callable[[Column], Column]) -> dict[tuple, float]:
    """For each of a few groups the value at place ``rank(number of rows)`` of its order, from 0; exact over all rows."""
    totals = running_totals(rows.withColumn("n", F.lit(1)), group, [value], ["n"])
    place = rank(F.col("n_total"))
    hit = totals.where((F.col("n_below") <= place) & (place < F.col("n_below") + F.col("n")))
    return {tuple(r[:-1]): r[-1] for r in hit.select(*group, value).collect()}


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    return docs.join(F.broadcast(sample), "doc_id")
