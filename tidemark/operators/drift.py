"""Population stability of features and scores, for any number of baseline/current pairs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import finite
from tidemark.operators.ordering import quantiles
from tidemark.params import FEATURES, PSI_POINTS, TEMPORAL_FEATURES, DriftPolicy


def long_features(df: DataFrame, keys: Sequence[str], features: Sequence[str] = FEATURES) -> DataFrame:
    """``keys, feature_no, value`` with non-finite values as NULL; features by position, a cheaper key."""
    wide = df.select(*keys, *[finite(F.col(f)).alias(f"f{i}") for i, f in enumerate(features)])
    stack = ", ".join(f"{i}, f{i}" for i in range(len(features)))
    return wide.select(*keys, F.expr(f"stack({len(features)}, {stack}) as (feature_no, value)"))


def consecutive_pairs(df: DataFrame, order: str = "snapshot_no") -> DataFrame:
    """Each row as the current side of its own pair and the baseline of the next snapshot's.

    Pairs without both sides come out with a NULL index.
    """
    sides = F.array(
        F.struct(F.lit("current").alias("side"), F.col(order).alias("pair")),
        F.struct(F.lit("baseline").alias("side"), (F.col(order) + 1).alias("pair")),
    )
    return df.withColumn("s", F.explode(sides)).select("*", "s.side", "s.pair").drop("s")


def stability_index(
    rows: DataFrame, group: Sequence[str], value: str = "value", points: Sequence[float] = PSI_POINTS
) -> DataFrame:
    """PSI per group of ``side`` (``baseline`` or ``current``) and ``value``.

    Bins are the baseline's distinct quantiles, open at both ends; every count is smoothed by one.
    NULL when a side is empty, 0 when the baseline has fewer than three distinct quantiles.
    """
    g = list(group)
    known = rows.where(F.col(value).isNotNull())
    q = quantiles(known.where(F.col("side") == "baseline"), g, value, points)
    edges = q.select(*g, F.array_distinct("q").alias("edges")).select(
        *g,
        (F.size("edges") - 1).alias("bins"),
        F.slice("edges", 2, F.greatest(F.size("edges") - 2, F.lit(0))).alias("inner"),
    )
    # One row of edges per group goes to the rows; the rows combine into bins on the map side.
    at_least = [F.coalesce(F.col(value) >= F.get("inner", F.lit(i)), F.lit(False)) for i in range(len(points) - 2)]
    binned = (
        known.join(F.broadcast(edges), g)
        .select(*g, "side", "bins", sum(c.cast("int") for c in at_least).alias("bin"))
        .groupBy(*g, "side", "bin")
        .agg(F.count("*").alias("n"), F.max("bins").alias("bins"))
    )
    counts = binned.groupBy(*g).agg(
        F.max("bins").alias("bins"),
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("side") == s, F.struct("bin", "n")))).alias(s)
            for s in ("baseline", "current")
        ],
    )
    return counts.select(*g, _psi(F.col("bins"), F.col("baseline"), F.col("current")).alias("psi"))


def _psi(k: Column, base: Column, cur: Column) -> Column:
    base_n = F.aggregate(F.map_values(base), F.lit(0).cast("bigint"), lambda a, x: a + x)
    cur_n = F.aggregate(F.map_values(cur), F.lit(0).cast("bigint"), lambda a, x: a + x)

    def term(i: Column) -> Column:
        b = (F.coalesce(F.try_element_at(base, i), F.lit(0)) + 1) / (base_n + k)
        c = (F.coalesce(F.try_element_at(cur, i), F.lit(0)) + 1) / (cur_n + k)
        return (c - b) * F.ln(c / b)

    total = F.aggregate(F.sequence(F.lit(0), k - 1), F.lit(0.0), lambda a, i: a + term(i))
    return F.when((F.size(base) == 0) | (F.size(cur) == 0), None).when(k < 2, 0.0).otherwise(total)


def feature_drift(
    rows: DataFrame,
    group: Sequence[str] = ("pair",),
    features: Sequence[str] = FEATURES,
    temporal: Sequence[str] = TEMPORAL_FEATURES,
) -> DataFrame:
    """PSI and drift type per pair and feature. ``rows`` carries ``side`` and the feature columns."""
    keys = [*group, "side"]
    known = stability_index(long_features(rows, keys, features), [*group, "feature_no"])
    names = F.posexplode(F.array(*[F.lit(f) for f in features])).alias("feature_no", "feature")
    spine = rows.groupBy(*group).agg((F.min("side") < F.max("side")).alias("paired")).where("paired")
    return (
        spine.select(*group, names)
        .join(known, [*group, "feature_no"], "left")
        .select(
            *group,
            "feature",
            "psi",
            F.when(F.col("feature").isin(*temporal), "expected_temporal").otherwise("behavioral").alias("drift_type"),
        )
    )


def prediction_drift(rows: DataFrame, group: Sequence[str], probability: str = "churn_probability") -> DataFrame:
    """PSI of the scores per group. ``rows`` carries ``side``."""
    scored = rows.withColumn("value", finite(F.col(probability)))
    return stability_index(scored, group).withColumnRenamed("psi", "prediction_psi")


def drift_rollup(report: DataFrame, group: Sequence[str] = ("pair",), temporal: Sequence[str] = TEMPORAL_FEATURES) -> DataFrame:
    """Largest PSI overall and over behavioral features, and one column per temporal feature."""
    return report.groupBy(*group).agg(
        F.max("psi").alias("max_feature_psi"),
        F.max(F.when(F.col("drift_type") == "behavioral", F.col("psi"))).alias("max_behavioral_feature_psi"),
        *[F.max(F.when(F.col("feature") == f, F.col("psi"))).alias(f"temporal_psi_{f}") for f in temporal],
    )


def top_drift(report: DataFrame, n: int = 5, group: Sequence[str] = ("pair",)) -> DataFrame:
    """The ``n`` features that drifted most, per pair; an unknown index ranks last, ties go by name.

    A report has one row per feature, so a pair is a handful of rows.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc_nulls_last("psi"), "feature"))
    return report.withColumn("place", place).where(F.col("place") <= n)


def drift_status(psi: Column, policy: DriftPolicy = DriftPolicy()) -> Column:
    return (
        F.when(psi.isNull(), "NOT_AVAILABLE")
        .when(psi >= policy.critical, "CRITICAL")
        .when(psi >= policy.warning, "WARNING")
        .otherwise("OK")
    )
