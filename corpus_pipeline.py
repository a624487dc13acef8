"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, contaminated documents go,
personal data is masked, and what is left is packed into sequences.

Every stage takes the documents that the one before it kept and, but for the last, returns the same columns. A document
is rejected as toxic at a score of 0.5 or more. Masked texts get a new ``n_chars``; all other rows pass as they are.

Defined results: columns beyond those of documents are left out; nulls in any column pass through, a null text counting
as empty where a stage reads it; null, empty and wordless texts are one near-duplicate group and are neither toxic nor
contaminated; rows that repeat id and text are one document after the second stage; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import small_batches, stored, table
from tidemark.llm.decontam import without_contaminated
from tidemark.llm.packing import pack
from tidemark.llm.privacy import personal_data, redacted
from tidemark.llm.simhash import without_duplicates
from tidemark.llm.toxicity import toxicity

#: Fixed value: the columns of documents.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
REJECT = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return toxicity(docs, table(spark, sf_dir, "labels"), keep=COLUMNS).where(F.col("score") < REJECT).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return without_duplicates(docs.select(*COLUMNS), shingle=3, max_distance=3).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = personal_data(docs, keep=COLUMNS[1:])
    masked = found.withColumn("masked", redacted(F.col("text"), "spans"))
    chars = F.when(F.size("spans") > 0, F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    return masked.select("doc_id", F.col("masked").alias("text"), "lang", "source", chars.alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("privacy", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL states neither the learned stages nor the tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
