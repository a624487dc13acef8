"""Monthly scoring with the champion, silent scoring with its predecessor, drift and monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import delayed, drift, features, models, scoring
from tidemark.operators.calendar import scoring_calendar
from tidemark.params import SnapshotPlan
from tidemark.plans.evaluate import resolve_matured
from tidemark.plans.ingest import ingest_batch
from tidemark.plans.workspace import Workspace
from tidemark.session import owns_scratch, small, written
from tidemark.sources import history

KEYS = ["snapshot_date", "CustomerID"]


def cohort_features(spark: SparkSession, ws: Workspace, snapshot_date: str, plan: SnapshotPlan) -> DataFrame:
    dates = spark.range(0, 1, 1, 1).select(F.lit(snapshot_date).cast("date").alias("as_of"))
    calendar = scoring_calendar(dates, plan)
    window, earlier = ws.feature_inputs(spark, calendar)
    return features.scoring_dataset(window, calendar, earlier)


def feature_table(spark: SparkSession, ws: Workspace, snapshot_date: str, plan: SnapshotPlan) -> DataFrame:
    """Features of the customers active before ``snapshot_date``; stored before anything reads them."""
    rows = written(cohort_features(spark, ws, snapshot_date, plan), "scoring")
    if rows.isEmpty():
        raise RuntimeError(f"no active customers before {snapshot_date}")
    history.write_feature_snapshot(rows, ws.path("features"))
    return rows


def score_with(spark, ws: Workspace, rows: DataFrame, meta, role: str, run_id: str, plan: SnapshotPlan) -> DataFrame:
    """Prediction rows of one model version."""
    model = models.load_model(ws.path("models"), meta["version"])
    aligned = scoring.align_features(rows, list(meta["feature_columns"]), KEYS)
    return scoring.score_projection(
        models.probabilities(model, aligned, KEYS),
        meta["threshold"],
        model_type=meta["model_type"],
        model_version=meta["version"],
        role=role,
        run_id=run_id,
        plan=plan,
    )


def version_meta(spark, ws: Workspace, version: str) -> dict:
    return ws.table(spark, "versions").where(F.col("version") == version).first().asDict()


@owns_scratch
def monthly_score(
    spark: SparkSession,
    ws: Workspace,
    snapshot_date: str,
    model_type: str,
    run_id: str,
    plan: SnapshotPlan = SnapshotPlan(),
) -> DataFrame:
    """Score the cohort of ``snapshot_date`` and append a monitoring row, which is returned. A failure is logged and raised."""
    try:
        return _monthly_score(spark, ws, snapshot_date, model_type, run_id, plan)
    except Exception as e:
        history.log_event(spark, ws.path("run_log"), stage="monthly_score", status="FAILED", snapshot_date=snapshot_date, run_id=run_id, error=str(e))
        raise


def _monthly_score(spark: SparkSession, ws: Workspace, snapshot_date: str, model_type: str, run_id: str, plan: SnapshotPlan) -> DataFrame:
    meta = ws.champion(spark, model_type)
    if meta is None:
        raise RuntimeError("no champion model")
    rows = feature_table(spark, ws, snapshot_date, plan)
    official = written(score_with(spark, ws, rows, meta, "official", run_id, plan), "official")
    history.write_predictions(official, ws.path("predictions"))
    shadow_error = _shadow(spark, ws, rows, meta, run_id, plan)
    row = monitoring_row(spark, ws, rows, official, meta, snapshot_date, run_id).withColumn("shadow_error", F.lit(shadow_error).cast("string"))
    row = written(row, "monitoring")
    history.append_history(row, ws.path("monitoring"))
    history.log_run(row.withColumn("stage", F.lit("monthly_score")), ws.path("run_log"))
    return small(row)


def _shadow(spark, ws: Workspace, rows: DataFrame, meta, run_id: str, plan: SnapshotPlan) -> str | None:
    """Score with the replaced champion. A failure here must not cost the official score: it is reported."""
    previous = meta["replaced_version"]
    if not previous or previous == meta["version"]:
        return None
    try:
        shadow = score_with(spark, ws, rows, version_meta(spark, ws, previous), "shadow", run_id, plan)
        history.write_predictions(shadow, ws.path("predictions"))
        return None
    except Exception as e:
        return str(e)


def monitoring_row(spark, ws: Workspace, rows: DataFrame, official: DataFrame, meta, snapshot_date: str, run_id: str) -> DataFrame:
    """Run summary with drift against the samples saved with the model."""
    version, names = meta["version"], list(meta["feature_columns"])
    side = lambda df, s: df.withColumn("side", F.lit(s)).withColumn("pair", F.lit(0))
    base = spark.read.parquet(ws.path(f"baselines/features/{version}")).select(*names)
    report = drift.feature_drift(side(base, "baseline").unionByName(side(rows.select(*names), "current")), features=names)
    report = written(report.withColumn("model_version", F.lit(version)), "drift")
    run = {"snapshot_date": F.lit(snapshot_date).cast("date"), "run_id": F.lit(run_id)}
    history.append_history(report.withColumns(run), ws.path("drift"))
    reference = spark.read.parquet(ws.path(f"baselines/scores/{version}")).select("churn_probability")
    scores = side(reference, "baseline").unionByName(side(official.select("churn_probability"), "current"))
    psi = drift.prediction_drift(scores, ["pair"])
    # Three one-row tables.
    summary = scoring.scoring_summary(official).withColumn("pair", F.lit(0))
    return summary.join(F.broadcast(drift.drift_rollup(report)), "pair", "left").join(F.broadcast(psi), "pair", "left").drop("pair").withColumn("run_id", run["run_id"])


@owns_scratch
def backfill_shadow(
    spark: SparkSession,
    ws: Workspace,
    snapshot_date: str,
    run_id: str,
    plan: SnapshotPlan = SnapshotPlan(),
    coverage: str | None = None,
) -> DataFrame:
    """Score a past cohort with the model that its official champion had replaced.

    With ``coverage`` (the data-through date) the new set is evaluated at once if it is mature.
    """
    stored = ws.table(spark, "predictions").where(
        (F.col("snapshot_date") == F.lit(snapshot_date).cast("date")) & (F.col("prediction_role") == "official")
    )
    version = stored.agg(F.max("model_version")).first()[0]
    if version is None:
        raise RuntimeError(f"no official predictions for {snapshot_date}")
    previous = version_meta(spark, ws, version)["replaced_version"]
    if not previous or previous == version:
        raise RuntimeError(f"no model preceded {version}")
    rows = cohort_features(spark, ws, snapshot_date, plan)
    shadow = written(score_with(spark, ws, rows, version_meta(spark, ws, previous), "shadow", run_id, plan), "shadow")
    history.write_predictions(shadow, ws.path("predictions"))
    if coverage is not None:
        resolve_matured(spark, ws, coverage, plan)
    mine = (F.col("snapshot_date") == F.lit(snapshot_date).cast("date")) & (F.col("prediction_role") == "shadow") & (F.col("model_version") == previous)
    return ws.table(spark, "predictions").where(mine)


def monthly_run(
    spark: SparkSession, ws: Workspace, source: str, snapshot_date: str, model_type: str, run_id: str, plan: SnapshotPlan = SnapshotPlan()
) -> dict:
    """One month: load the batch, score the cohort, evaluate what has matured. Returns the run summary."""
    loaded = ingest_batch(spark, ws, source, snapshot_date)
    row = monthly_score(spark, ws, snapshot_date, model_type, run_id, plan).first().asDict()
    resolved = resolve_matured(spark, ws, snapshot_date, plan)
    counts = {"prediction_sets_evaluated": 0, "cohorts_evaluated": 0}
    if resolved is not None:
        counts = delayed.resolved_rollup(resolved).first().asDict()
    return {"new_ingestion": loaded, **row, **counts}
