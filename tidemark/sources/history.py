"""Append-only tables: predictions, histories, manifests and run logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sources.transactions import is_missing

MANIFEST = T.StructType(
    [
        T.StructField(n, t)
        for n, t in (
            ("source_file", T.StringType()),
            ("archived_file", T.StringType()),
            ("sha256", T.StringType()),
            ("snapshot_date", T.StringType()),
            ("status", T.StringType()),
            ("raw_rows", T.LongType()),
            ("clean_rows", T.LongType()),
            ("error", T.StringType()),
            ("recorded_at", T.StringType()),
        )
    ]
)

_METRICS = "struct<roc_auc: double, pr_auc: double, accuracy: double, precision: double, recall: double, f1: double, brier_score: double>"
METADATA = f"version string, model_type string, snapshot_date date, threshold double, metrics {_METRICS}, validation_metrics {_METRICS}, test_metrics {_METRICS}"


def evolve(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Old and new rows under the old columns followed by the new ones; absent values are NULL."""
    return stored.unionByName(incoming, allowMissingColumns=True)


def append_history(df: DataFrame, path: str) -> None:
    """Append rows whose columns may have grown. Nothing already written is read or rewritten."""
    df.write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The history under the union of all columns ever written, or None before the first append."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def append_manifest(df: DataFrame, path: str) -> None:
    """Append manifest records as JSON lines; the time of recording is filled in when absent."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    given = F.col("recorded_at") if "recorded_at" in df.columns else F.lit(None).cast("string")
    df.withColumn("recorded_at", F.coalesce(given, now)).write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest records; an empty table before the first one."""
    try:
        return spark.read.schema(MANIFEST).json(path)
    except AnalysisException as e:
        if is_missing(e):
            return spark.createDataFrame([], MANIFEST)
        raise


def read_metadata(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Metadata and metrics of models as records: JSON lines, or (``lines=False``) files that each hold an object or a list of them.

    Further keys are ignored and absent ones are NULL; a number that JSON does not have (NaN, Infinity) is NULL too. A file that is
    no JSON raises.
    """
    df = spark.read.schema(METADATA).options(multiLine=not lines, mode="FAILFAST", pathGlobFilter="*.json").json(path)
    number = lambda c: F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)
    out = {"threshold": number(F.col("threshold"))}
    for f in df.schema:
        if isinstance(f.dataType, T.StructType):
            clean = F.struct(*[number(F.col(f.name)[m]).alias(m) for m in f.dataType.names])
            out[f.name] = F.when(F.col(f.name).isNotNull(), clean)
    return df.withColumns(out)


def log_run(df: DataFrame, path: str) -> None:
    """Append run summaries as JSON lines with a default timestamp."""
    if "timestamp" not in df.columns:
        df = df.withColumn("timestamp", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))
    df.write.mode("append").json(path)


def log_event(spark: SparkSession, path: str, **fields) -> None:
    """Append one record of what a plan did or why it did not."""
    text = {k: v if v is None else str(v) for k, v in fields.items()}
    log_run(spark.createDataFrame([text], ", ".join(f"{k} string" for k in text)), path)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Size, number of lines and content hash of each text file of any size.

    Files are read in splits. The hash is over the number of lines and the sum of the lines' own hashes, so it
    does not depend on how a file is split; files that hold the same lines in another order count as equal.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .text(path)
        .select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_size").alias("bytes"), line_hash(F.col("value")).alias("h"))
    )
    files = lines.groupBy("source_file").agg(F.max("bytes").alias("bytes"), F.count("*").alias("lines"), F.sum("h").alias("line_sum"))
    content = F.concat_ws(":", F.col("lines").cast("string"), F.col("line_sum").cast("string"))
    return files.select("source_file", "bytes", "lines", "line_sum", F.sha2(content, 256).alias("sha256"))


def line_hash(line: Column) -> Column:
    """The first 60 bits of a line's SHA-256, as a number that adds up exactly."""
    return F.conv(F.substring(F.sha2(line.cast("binary"), 256), 1, 15), 16, 10).cast("decimal(20, 0)")


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions by snapshot, role and version. A rescored set replaces only its own partition.

    A cohort of any size is split over several files instead of funnelling into one task.
    """
    _replace(df, path, ["snapshot_date", "prediction_role", "model_version"])


def _replace(df: DataFrame, path: str, keys: list[str]) -> None:
    """Write ``df`` over the partitions that it has rows of, in files of even size."""
    (
        df.hint("rebalance", *[F.col(k) for k in keys])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_execution(df: DataFrame, path: str, execution_id: str) -> None:
    """One execution's rows under its own folder; earlier executions stay untouched, a rerun replaces its own."""
    _replace(df.withColumn("execution_id", F.lit(execution_id)), path, ["snapshot_date", "execution_id"])


def write_calibration(df: DataFrame, path: str) -> None:
    """Calibration rows by prediction set; a set evaluated again replaces its own rows."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date", "prediction_role", "model_version").parquet(path)


def write_feature_snapshot(df: DataFrame, path: str) -> None:
    """The features as scored, for audits and later drift baselines. A rerun replaces the cohort's rows."""
    _replace(df, path, ["snapshot_date"])


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """A small result (metrics, drift, thresholds, alerts) as parquet, json or csv."""
    if fmt not in ("parquet", "json", "csv"):
        raise ValueError(f"unsupported report format {fmt!r}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
