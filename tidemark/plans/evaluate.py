"""Resolving matured predictions: labels, metrics, calibration and official/shadow comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import calibration, delayed, labels, quality
from tidemark.params import LABEL, SnapshotPlan
from tidemark.plans.workspace import Workspace
from tidemark.session import owns_scratch, small, written
from tidemark.sources import history


@owns_scratch
def resolve_matured(spark: SparkSession, ws: Workspace, current: str, plan: SnapshotPlan = SnapshotPlan()) -> DataFrame | None:
    """Evaluate every matured prediction set not evaluated before. Returns the new rows, or None."""
    predictions = ws.table(spark, "predictions")
    if predictions is None:
        return None
    done = ws.table(spark, "performance")
    mature = delayed.matured(predictions, F.lit(current).cast("timestamp_ntz"), plan)
    sets = delayed.prediction_sets(mature)
    if done is not None:
        sets = delayed.unevaluated_sets(sets, done)
    sets = written(sets, "sets")
    if sets.isEmpty():
        return None
    # A set is a row per cohort and model: a planning table.
    todo = mature.join(F.broadcast(sets), list(delayed.COHORT), "left_semi")
    # A table of counts, a row per cohort.
    broken = quality.prediction_quality(todo.withColumn("cohort", F.concat_ws(" ", *delayed.COHORT)), "cohort").where(~F.col("passed"))
    bad = [r.asDict() for r in broken.collect()]
    if bad:
        history.log_event(spark, ws.path("run_log"), stage="evaluate", status="FAILED", error=f"prediction tables break their rules: {bad}")
        raise ValueError(f"prediction tables break their rules: {bad}")
    outcome = _labels(spark, ws, todo, current, plan)
    resolved = written(delayed.resolved_predictions(todo, outcome), "resolved")
    delayed.require_unique(resolved, [*delayed.COHORT, "CustomerID"])
    history.write_predictions(resolved, ws.path("evaluated"))
    metrics = delayed.delayed_evaluation(resolved)
    metrics = metrics.unionByName(delayed.unevaluable_sets(sets, metrics), allowMissingColumns=True)
    metrics = written(metrics.withColumn("evaluated_at", F.lit(current)), "metrics")
    # A set counts as evaluated once it is in ``performance``, which therefore comes last. What an attempt that failed
    # left in the other two is replaced or not repeated.
    history.write_calibration(calibration.calibration_deciles(resolved, delayed.COHORT, LABEL), ws.path("calibration"))
    compared = ws.table(spark, "shadow_comparison")
    known = metrics if done is None else history.evolve(done, metrics)
    history.append_history(written(delayed.shadow_comparison(known, compared), "comparison"), ws.path("shadow_comparison"))
    history.append_history(metrics, ws.path("performance"))
    return small(metrics)


def _labels(spark: SparkSession, ws: Workspace, cohort: DataFrame, current: str, plan: SnapshotPlan) -> DataFrame:
    """Stored labels of the cohorts, after adding those still missing."""
    stored = ws.table(spark, "labels")
    keys = list(labels.KEYS)
    fresh = cohort if stored is None else cohort.join(stored.select(*keys), keys, "left_anti")
    windows = written(labels.outcome_windows(fresh, plan), "windows")
    first = windows.agg(F.min("outcome_start")).first()[0]
    if first is None:  # every customer has a label
        return stored
    sales = ws.curated(spark, since=first, before=current)
    made = labels.outcome_labels(fresh, sales, plan, windows, resolved_at=current)
    if stored is not None:  # a date's rows are replaced together
        made = labels.upsert_labels(stored.join(F.broadcast(windows.select("snapshot_date")), "snapshot_date", "left_semi").select(*made.columns), made)
    made = written(made, "labels")
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_date").parquet(ws.path("labels"))
    return ws.table(spark, "labels")
