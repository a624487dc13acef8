"""Loading one delivered batch: identify, validate, clean, compare with history, merge, record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import quality
from tidemark.operators.lineage import new_ingestions
from tidemark.params import QualityPolicy
from tidemark.plans.workspace import Workspace
from tidemark.session import owns_scratch, written
from tidemark.sources import history
from tidemark.sources.store import monthly_volumes, update_curated
from tidemark.sources.transactions import (
    clean_transactions,
    parse_raw,
    point_in_time_union,
    require_disjoint,
    scan_raw,
    scan_transactions,
)


def _record(spark: SparkSession, ws: Workspace, files: DataFrame, **fields) -> None:
    for k, v in fields.items():
        files = files.withColumn(k, F.lit(v))
    history.append_manifest(files, ws.path("manifest"))


@owns_scratch
def ingest_batch(
    spark: SparkSession, ws: Workspace, source: str, snapshot_date: str, policy: QualityPolicy = QualityPolicy()
) -> bool:
    """Load the files under ``source`` as the month before ``snapshot_date``.

    False when every file was loaded before for that snapshot. A failed check raises after recording it. The files
    are parsed once: everything after works on the stored lines.
    """
    incoming = history.file_inventory(spark, source, "*.[cC][sS][vV]").withColumn("snapshot_date", F.lit(snapshot_date))
    fresh = [r.asDict() for r in new_ingestions(incoming, ws.manifest(spark)).select("source_file", "sha256", "snapshot_date").collect()]
    if not fresh:
        return False
    files = spark.createDataFrame(fresh, "source_file string, sha256 string, snapshot_date string")
    try:
        text = written(scan_raw(spark, [f["source_file"] for f in fresh]), "batch-text")
        quality.require_quality(quality.structural_quality(text, policy))
        raw = parse_raw(text)
        quality.require_batch_month(raw, snapshot_date)
        clean = written(clean_transactions(raw), "batch")
        past = monthly_volumes(spark, ws.path("curated"))  # from the log; no past line is read
        checks = quality.volume_check(clean, quality.monthly_baseline(past, policy), policy)
        checks = checks.where(F.col("status").isin("ERROR", "WARNING"))
        odd = [r.asDict() for r in checks.collect()]  # three rows at most
        if odd:
            history.log_run(checks.select(F.lit("ingest").alias("stage"), F.lit(snapshot_date).alias("snapshot_date"), "metric", "status", "value", "z_score"), ws.path("run_log"))
        bad = [r for r in odd if r["status"] == "ERROR"]
        if bad:
            raise ValueError(f"monthly volume out of bounds: {bad}")
        rows = text.count(), clean.count()
        update_curated(spark, ws.path("curated"), clean)
    except Exception as e:
        _record(spark, ws, files, status="FAILED", error=str(e))
        history.log_event(spark, ws.path("run_log"), stage="ingest", status="FAILED", snapshot_date=snapshot_date, error=str(e))
        raise
    _record(spark, ws, files, status="SUCCESS", raw_rows=rows[0], clean_rows=rows[1])
    return True


@owns_scratch
def bootstrap_store(spark: SparkSession, ws: Workspace, sources: list[str], policy: QualityPolicy = QualityPolicy()) -> None:
    """First load of the whole history. No manifest record: coverage falls back to the last event."""
    text = written(scan_raw(spark, sources), "bootstrap-text")
    quality.require_quality(quality.structural_quality(text, policy))
    update_curated(spark, ws.path("curated"), written(clean_transactions(parse_raw(text)), "bootstrap"))


def reconstruct_history(
    spark: SparkSession,
    bootstrap: str | list[str],
    replay: str | list[str],
    as_of: str,
    whole_bootstrap: bool = False,
    policy: QualityPolicy = QualityPolicy(),
) -> DataFrame:
    """Clean history strictly before ``as_of`` from two CSV feeds, for runs that keep no store."""
    cut = F.lit(as_of).cast("timestamp_ntz")
    old, new = scan_transactions(spark, bootstrap), scan_transactions(spark, replay)
    require_disjoint(old, new, cut, whole_bootstrap)
    raw = point_in_time_union(old, new, cut)
    quality.require_quality(quality.structural_quality(raw, policy))
    return clean_transactions(raw)
