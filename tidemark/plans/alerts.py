"""Alert signals and their rollup from the stored monitoring and performance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import governance
from tidemark.params import AlertPolicy
from tidemark.plans.workspace import Workspace
from tidemark.session import owns_scratch, small, written
from tidemark.sources import history


def latest_run(report: DataFrame) -> DataFrame:
    """The drift rows of the last run of each date, a run's row for a feature once. Rows without a run are older ones."""
    if "run_id" not in report.columns:
        return report.dropDuplicates(["snapshot_date", "feature"])
    last = F.max_by(F.struct(*[c for c in report.columns if c not in ("snapshot_date", "feature")]), F.coalesce("run_id", F.lit(""))).alias("last")
    newest = report.groupBy("snapshot_date").agg(F.max(F.coalesce("run_id", F.lit(""))).alias("newest"))
    of_run = report.join(F.broadcast(newest), "snapshot_date").where(F.coalesce("run_id", F.lit("")) == F.col("newest")).drop("newest")  # a row per date
    return of_run.groupBy("snapshot_date", "feature").agg(last).select("snapshot_date", "feature", "last.*")


@owns_scratch
def evaluate_alerts(spark: SparkSession, ws: Workspace, reference_model: str, policy: AlertPolicy = AlertPolicy()) -> DataFrame:
    """Signals of every monitored run; alerts never stop a pipeline."""
    # A run may lack the summary of its drift; then the stored drift rows give it. Reruns of a date are one run.
    latest = F.max_by(F.struct("prediction_psi", "max_behavioral_feature_psi"), "run_id").alias("run")
    runs = ws.table(spark, "monitoring").groupBy("snapshot_date").agg(latest).select("snapshot_date", "run.*")
    report = ws.table(spark, "drift")
    if report is not None:
        report = latest_run(report)
        runs = governance.behavioral_psi(runs, report, "snapshot_date")
    done = ws.table(spark, "performance")
    empty = spark.createDataFrame([], "snapshot_date date, model_lineage string, roc_auc double, recall double, brier_score double")
    delayed = empty if done is None else done.where(F.col("prediction_role") == "official").select(
        "snapshot_date", F.col("model_version").alias("model_lineage"), "roc_auc", "recall", "brier_score"
    )
    versions = ws.table(spark, "versions").where(F.col("version") == reference_model)
    pick = lambda c: F.struct(*[F.col(c)[m].alias(m) for m in governance.REFERENCE_METRICS]).alias(c)
    reference = governance.resolve_reference(versions.select("version", pick("test_metrics"), pick("metrics"))).select(
        F.col("version").alias("reference_model"), *[f"reference_{m}" for m in governance.REFERENCE_METRICS]
    )
    # Every side is a planning table with a row per run or version.
    joined = (
        runs.join(F.broadcast(delayed), "snapshot_date", "left")
        .withColumn("evaluated", F.col("recall").isNotNull())
        .withColumn("reference_model", F.lit(reference_model))
        .join(F.broadcast(reference), "reference_model", "left")
    )
    signals = written(governance.alert_signals(joined, policy=policy), "signals")
    history.write_report(signals, ws.path("reports/alert_signals"), "csv")
    rollup = governance.alert_rollup(signals)
    history.write_report(rollup, ws.path("reports/alert_summary"), "json")
    return small(rollup)
