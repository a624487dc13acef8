"""Champion bootstrap and quarterly retraining with promotion guardrails."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import calendar as cal
from tidemark.operators import features, governance, metrics, models, scoring
from tidemark.params import LABEL, DriftPolicy, GuardrailPolicy, SnapshotPlan, SplitPlan
from tidemark.plans.workspace import Workspace
from tidemark.session import owns_scratch, written
from tidemark.sources import history

ROLE = ["role"]


def readiness(spark, ws: Workspace, meta, plan: SnapshotPlan, split: SplitPlan, force: bool):
    """Readiness row and the coverage it rests on."""
    coverage = cal.manifest_coverage(ws.manifest(spark), ws.curated(spark))
    end = coverage.first().coverage_end
    known = cal.known_coverage(spark, end)
    last = None if meta is None else meta["latest_snapshot_used"]
    status = cal.available_snapshots(known, plan).withColumn("champion_latest_snapshot", F.lit(last).cast("int"))
    return cal.retrain_readiness(status, split, force).first(), known


def split_rows(spark, ws: Workspace, known: DataFrame, plan: SnapshotPlan, split: SplitPlan) -> DataFrame:
    """Features and labels of the rolling split, written once: every fit and evaluation reads it."""
    calendar = cal.labelled_calendar(known, plan)
    parts = cal.rolling_split(calendar, split)
    wanted = calendar.join(F.broadcast(parts), "snapshot_no", "left_semi")
    window, earlier = ws.feature_inputs(spark, wanted)
    rows = features.training_dataset(window, wanted, earlier)
    return written(rows.join(F.broadcast(parts), "snapshot_no"), "split")


def evaluate(scored: DataFrame, threshold: float) -> dict:
    """All metrics of one scored cohort as a dictionary of numbers."""
    scores = metrics.score_table(scored.withColumn("role", F.lit("one")), ROLE, LABEL, threshold=F.lit(float(threshold)))
    row = metrics.model_evaluation(scores, ROLE).drop("role").first().asDict()
    return {**row, "threshold": float(threshold)}


@owns_scratch
def retrain(
    spark: SparkSession,
    ws: Workspace,
    version: str,
    model_type: str,
    promoted_at,
    *,
    plan: SnapshotPlan = SnapshotPlan(),
    split: SplitPlan = SplitPlan(),
    guardrails: GuardrailPolicy = GuardrailPolicy(),
    candidate: tuple[Pipeline, dict] | None = None,
    retune_grid: dict | None = None,
    metric: str = "youden_j",
    force: bool = False,
    parallelism: int = 2,
) -> dict:
    """Train a challenger on the newest labelled snapshots and promote it if the guardrails allow.

    The first model is promoted without a comparison. The test cohort is only scored after a promotion.
    """
    meta = ws.champion(spark, model_type)
    ready, known = readiness(spark, ws, meta, plan, split, force)
    if ready.retrain_skipped:
        history.log_event(spark, ws.path("run_log"), stage="retrain", status="SKIPPED", version=version, model_type=model_type, reason=ready.reason)
        return {"retrain_skipped": True, "reason": ready.reason, "promote": False, "available": ready.available}
    rows = split_rows(spark, ws, known, plan, split)
    part = {s: rows.where(F.col("split") == s) for s in ("train", "val", "test")}
    if retune_grid is not None:
        model, params, _ = models.tune(model_type, part["train"], retune_grid, parallelism)
    else:
        pipeline, params = candidate or models.production_candidate(model_type)
        cv = models.forward_validation(pipeline, part["train"], parallelism) if split.train > 1 else []
        model = models.fit(pipeline, part["train"])
    val = written(models.probabilities(model, part["val"], ["CustomerID", LABEL]), "val")
    scores = metrics.score_table(val.withColumn("role", F.lit("challenger")), ROLE, LABEL)
    sweep = metrics.threshold_sweep(scores, ROLE)
    threshold = metrics.best_threshold(sweep, ROLE, metric).first().best_threshold
    challenger = evaluate(val, threshold)
    if retune_grid is None:
        challenger["cv_roc_auc"] = models.mean_auc(cv)
    decision, champion = {"promote": True, "reason": "no_champion"}, None
    if meta is not None:
        old = models.load_model(ws.path("models"), meta["version"])
        aligned = scoring.align_features(
            part["val"].drop("split", "snapshot_no", "snapshot_date"), list(meta["feature_columns"]), ["CustomerID", LABEL]
        )
        champion = evaluate(models.probabilities(old, aligned, ["CustomerID", LABEL]), meta["threshold"])
        decision = promotion(spark, challenger, champion, guardrails)
    result = {**decision, "challenger": challenger, "champion": champion, "threshold": threshold, "retrain_skipped": False}
    numbers = cal.split_numbers(int(ready.available), split)
    if not decision["promote"]:
        history.log_event(
            spark, ws.path("run_log"), stage="retrain", status="BLOCKED", version=version, model_type=model_type, reason=decision["reason"],
            challenger=challenger, champion=champion,
        )
        return result
    tested = evaluate(models.probabilities(model, part["test"], ["CustomerID", LABEL]), threshold)
    models.save_model(model, ws.path("models"), version)
    sample = scoring.reference_sample(part["train"], DriftPolicy().baseline_rows, ["snapshot_date", "CustomerID"])
    sample = written(sample, "sample")
    history.write_report(sample, ws.path(f"baselines/features/{version}"))
    history.write_report(models.probabilities(model, sample, []), ws.path(f"baselines/training_scores/{version}"))
    history.write_report(val.select("churn_probability"), ws.path(f"baselines/scores/{version}"))
    history.write_report(sweep, ws.path(f"reports/{version}/threshold_sweep"), "csv")
    if hasattr(model, "importance"):
        history.write_report(models.feature_importance(model), ws.path(f"reports/{version}/feature_importance"), "csv")
    row = models.version_row(
        spark,
        version,
        model_type,
        params=params,
        metrics=challenger,
        test_metrics=tested,
        snapshots=numbers,
        latest_snapshot=numbers["test"][-1],
        threshold=threshold,
        promoted_at=promoted_at,
        replaced_version=None if meta is None else meta["version"],
    )
    history.append_history(row, ws.path("versions"))
    return {**result, "test": tested}


def promotion(spark: SparkSession, challenger: dict, champion: dict, policy: GuardrailPolicy) -> dict:
    names = list(dict.fromkeys((policy.metric, "recall", "brier_score")))
    row = {f"{side}_{m}": d[m] for side, d in (("challenger", challenger), ("champion", champion)) for m in names}
    pairs = spark.createDataFrame([row], ", ".join(f"{k} double" for k in row))
    return governance.promotion_decision(pairs, policy).select("promote", "reason", "failed_checks").first().asDict()
