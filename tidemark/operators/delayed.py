"""Evaluating past predictions once their outcome is known, all cohorts and roles in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.temporal import midnight, shift
from tidemark.operators.calibration import calibration_deciles, expected_calibration_error
from tidemark.operators.metrics import class_counts, class_metrics, ranking_metrics, score_table
from tidemark.params import LABEL, SnapshotPlan

COHORT = ("snapshot_date", "model_version", "prediction_role")
KEYS = ("snapshot_date", "CustomerID")


def role_or_official(df: DataFrame) -> Column:
    """The prediction role; rows and tables older than the column are official."""
    return F.coalesce(F.col("prediction_role"), F.lit("official")) if "prediction_role" in df.columns else F.lit("official")


def matured(predictions: DataFrame, current: Column, plan: SnapshotPlan = SnapshotPlan()) -> DataFrame:
    """Predictions whose whole outcome window lies before ``current``. The cut prunes by snapshot date."""
    end = shift(midnight(F.col("snapshot_date")), plan.outcome, plan.unit)
    return predictions.where(end <= current)


def matured_cohorts(
    runs: DataFrame, cohorts: DataFrame, first_prediction: Column, plan: SnapshotPlan = SnapshotPlan()
) -> DataFrame:
    """Per ``as_of`` date the snapshot to evaluate, and why an evaluation is skipped.

    ``cohorts`` lists the snapshot dates with stored predictions.
    """
    snap = shift(midnight(F.col("as_of")), -plan.outcome, plan.unit).cast("date")
    stored = F.broadcast(cohorts.select("snapshot_date").distinct().withColumn("stored", F.lit(True)))
    early = F.col("evaluation_snapshot") < first_prediction
    missing = F.col("stored").isNull()
    return (
        runs.withColumn("evaluation_snapshot", snap)
        .join(stored, F.col("evaluation_snapshot") == F.col("snapshot_date"), "left")
        .select(
            "as_of",
            "evaluation_snapshot",
            (early | missing).alias("evaluation_skipped"),
            F.when(early, "not_mature").when(missing, "no_predictions").alias("reason"),
        )
    )


def prediction_sets(predictions: DataFrame) -> DataFrame:
    """Distinct (snapshot, version, role) sets."""
    return predictions.select("snapshot_date", "model_version", role_or_official(predictions).alias("prediction_role")).distinct()


def unevaluated_sets(sets: DataFrame, history: DataFrame) -> DataFrame:
    """Sets without a row in the performance history; a missing role there means official."""
    done = history.select("snapshot_date", "model_version", role_or_official(history).alias("prediction_role")).distinct()
    return sets.join(done, list(COHORT), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def require_unique(df: DataFrame, keys: Sequence[str] = KEYS) -> None:
    bad = duplicate_keys(df, keys).first()
    if bad is not None:
        raise ValueError(f"keys {list(keys)} are not unique: {bad.asDict()}")


def resolved_predictions(predictions: DataFrame, outcomes: DataFrame, check: bool = False) -> DataFrame:
    """Predictions that have an outcome, one to one on (snapshot, customer).

    With ``check`` repeated keys on either side raise, at the price of one aggregation each.
    """
    if check:
        require_unique(predictions, [*COHORT, "CustomerID"] if set(COHORT) <= set(predictions.columns) else KEYS)
        require_unique(outcomes)
    return predictions.join(outcomes.select(*KEYS, LABEL), list(KEYS))


def delayed_evaluation(resolved: DataFrame, cohort: Sequence[str] = COHORT, bins: int = 10) -> DataFrame:
    """Every delayed metric per prediction set, reclassified with the stored threshold (0.5 if none)."""
    threshold = F.col("threshold_used") if "threshold_used" in resolved.columns else F.lit(0.5)
    scores = score_table(resolved, cohort, LABEL, threshold=threshold)
    c = class_counts(scores, cohort)
    m = class_metrics(c)
    ece = expected_calibration_error(calibration_deciles(resolved, cohort, LABEL, bins=bins), cohort)
    return (
        c.select(*cohort, F.col("n").alias("n_resolved"), *[v.alias(k) for k, v in m.items()])
        # One row per prediction set on every side.
        .join(F.broadcast(ranking_metrics(scores, cohort)), list(cohort))
        .join(F.broadcast(ece), list(cohort))
    )


def unevaluable_sets(sets: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Sets whose customers have no outcome at all: ``n_resolved`` 0."""
    return sets.join(evaluated.select(*COHORT), list(COHORT), "left_anti").withColumn("n_resolved", F.lit(0).cast("bigint"))


def single_value(c: str) -> Column:
    """The value of a column when it has exactly one distinct non-null value, else NULL."""
    return F.when(F.min(c) == F.max(c), F.max(c))


def delayed_evaluation_stored(resolved: DataFrame, cohort: Sequence[str] = ("snapshot_date",), run_id: str = "run_id") -> DataFrame:
    """Metrics from the class stored at scoring time, with the cohort's lineage when it is unique."""
    scores = score_table(resolved, cohort, LABEL, predicted=F.col("predicted_churn"))
    c = class_counts(scores, cohort)
    m = class_metrics(c)
    lineage = resolved.groupBy(*cohort).agg(
        single_value("threshold_used").alias("threshold"),
        single_value("model_version").alias("model_lineage"),
        single_value(run_id).alias("scoring_run_id"),
        F.count_if(F.col(LABEL) == 0).alias("customers_with_positive_sale"),
    )
    names = ("accuracy", "precision", "recall", "f1", "brier_score", "mean_churn_probability", "actual_churn_rate", "predicted_churn_rate")
    return (
        c.select(*cohort, F.col("n").alias("customers_evaluated"), "tn", "fp", "fn", "tp", *[m[k].alias(k) for k in names])
        .join(F.broadcast(ranking_metrics(scores, cohort)), list(cohort))
        .join(F.broadcast(lineage), list(cohort))
    )


def resolved_rollup(evaluated: DataFrame) -> DataFrame:
    """Prediction sets and distinct cohorts evaluated in a run."""
    per_date = evaluated.groupBy("snapshot_date").agg(F.count("*").alias("sets"))
    return per_date.agg(
        F.coalesce(F.sum("sets"), F.lit(0)).alias("prediction_sets_evaluated"), F.count("*").alias("cohorts_evaluated")
    )


def shadow_comparison(history: DataFrame, done: DataFrame | None = None, order: str = "evaluated_at") -> DataFrame:
    """Official against shadow on the same cohort: the last row of each role, and the four deltas.

    Only cohorts that have both roles and are not in ``done``.
    """
    metrics = ("roc_auc", "pr_auc", "recall", "brier_score")
    rows = history.withColumn("prediction_role", role_or_official(history))
    if done is not None:
        rows = rows.join(done.select("snapshot_date").distinct(), "snapshot_date", "left_anti")
    picked = [
        F.max_by(
            F.when(F.col("prediction_role") == role, F.struct("model_version", *metrics)),
            F.when(F.col("prediction_role") == role, F.struct(order, "model_version")),
        ).alias(role)
        for role in ("official", "shadow")
    ]
    both = rows.groupBy("snapshot_date").agg(*picked).where(F.col("official").isNotNull() & F.col("shadow").isNotNull())
    cols = []
    for m in metrics:
        short = "brier" if m == "brier_score" else m
        cols += [
            F.col(f"official.{m}").alias(f"official_{m}"),
            F.col(f"shadow.{m}").alias(f"shadow_{m}"),
            (F.col(f"official.{m}") - F.col(f"shadow.{m}")).alias(f"{short}_delta_official_minus_shadow"),
        ]
    return both.select(
        "snapshot_date",
        F.col("official.model_version").alias("official_model_version"),
        F.col("shadow.model_version").alias("shadow_model_version"),
        *cols,
    )
