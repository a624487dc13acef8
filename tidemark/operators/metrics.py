"""Classification, ranking and probability metrics per cohort, all from one collapsed score table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.numeric import ratio
from tidemark.operators.ordering import running_totals
from tidemark.params import SWEEP_METRICS, SWEEP_THRESHOLDS


def score_table(
    rows: DataFrame,
    cohort: Sequence[str],
    outcome: str,
    probability: str = "churn_probability",
    predicted: Column | None = None,
    threshold: Column | None = None,
) -> DataFrame:
    """One row per cohort, score, class and threshold with positive and negative counts.

    Equal scores combine on the map side, so a cohort of any size arrives as its distinct scores.
    The class is ``score >= threshold`` unless ``predicted`` gives a stored one.
    """
    t = F.lit(0.5) if threshold is None else threshold
    p = F.col(probability).cast("double")
    hit = F.col(outcome) == 1
    return rows.groupBy(
        *cohort,
        p.alias("score"),
        t.cast("double").alias("threshold"),
        ((p >= t).cast("int") if predicted is None else predicted.cast("int")).alias("predicted"),
    ).agg(F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg"))


def outcome_rows(rows: DataFrame, cohort: Sequence[str], outcome: str, probability: str = "churn_probability") -> DataFrame:
    """Scores with ``pos`` and ``neg`` for what needs no table of distinct scores: no shuffle."""
    hit = F.col(outcome) == 1
    one = lambda c: F.coalesce(c.cast("long"), F.lit(0).cast("long"))
    return rows.select(*cohort, F.col(probability).cast("double").alias("score"), one(hit).alias("pos"), one(~hit).alias("neg"))


def class_counts(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    """Confusion matrix and probability sums per cohort."""
    n = F.col("pos") + F.col("neg")
    yes = F.col("predicted") == 1
    p = F.col("score")
    cell = lambda when, c: F.sum(F.when(when, F.col(c)).otherwise(0))
    return scores.groupBy(*cohort).agg(
        F.sum(n).alias("n"),
        cell(~yes, "neg").alias("tn"),
        cell(yes, "neg").alias("fp"),
        cell(~yes, "pos").alias("fn"),
        cell(yes, "pos").alias("tp"),
        F.sum(p * n).alias("sum_p"),
        F.sum(F.col("pos") * (1 - p) * (1 - p) + F.col("neg") * p * p).alias("sum_sq"),
        F.sum(F.col("threshold") * n).alias("sum_t"),
    )


def class_metrics(c: DataFrame) -> dict[str, Column]:
    """Expressions over the columns of :func:`class_counts`."""
    tn, fp, fn, tp, n = (F.col(x) for x in ("tn", "fp", "fn", "tp", "n"))
    return {
        "accuracy": ratio(tp + tn, n),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "brier_score": F.col("sum_sq") / n,
        "mean_churn_probability": F.col("sum_p") / n,
        "actual_churn_rate": ratio(tp + fn, n),
        "predicted_churn_rate": ratio(tp + fp, n),
        "calibration_gap": F.col("sum_p") / n - ratio(tp + fn, n),
        "mean_threshold_used": F.col("sum_t") / n,
    }


def confusion_matrix(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    return class_counts(scores, cohort).select(*cohort, "tn", "fp", "fn", "tp")


def classification_metrics(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    c = class_counts(scores, cohort)
    m = class_metrics(c)
    return c.select(*cohort, *[m[k].alias(k) for k in ("accuracy", "precision", "recall", "f1")])


def probability_metrics(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    c = class_counts(scores, cohort)
    m = class_metrics(c)
    names = (
        "brier_score", "mean_churn_probability", "actual_churn_rate",
        "predicted_churn_rate", "calibration_gap", "mean_threshold_used",
    )
    return c.select(*cohort, *[m[k].alias(k) for k in names])


def ranking_metrics(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    """Tie-aware ROC-AUC and average precision; both NULL for a single-class cohort."""
    r = running_totals(scores, cohort, ["score"], ["pos", "neg"])
    pos, neg = F.col("pos"), F.col("neg")
    p_all, n_all = F.max("pos_total"), F.max("neg_total")
    # Scores at or above this one: everything that is not strictly below.
    tp = F.col("pos_total") - F.col("pos_below")
    fp = F.col("neg_total") - F.col("neg_below")
    pairs = F.sum(pos.cast("double") * (F.col("neg_below") + neg / 2))
    steps = F.sum(ratio(pos, F.col("pos_total")) * ratio(tp, tp + fp))
    both = (p_all > 0) & (n_all > 0)
    return r.groupBy(*cohort).agg(
        F.when(both, pairs / (p_all.cast("double") * n_all)).alias("roc_auc"),
        F.when(both, steps).alias("pr_auc"),
    )


def roc_auc(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    return ranking_metrics(scores, cohort).select(*cohort, "roc_auc")


def average_precision(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    return ranking_metrics(scores, cohort).select(*cohort, "pr_auc")


def model_evaluation(scores: DataFrame, cohort: Sequence[str]) -> DataFrame:
    """One record of every metric per cohort."""
    c = class_counts(scores, cohort)
    m = class_metrics(c)
    flat = c.select(*cohort, "n", "tn", "fp", "fn", "tp", *[v.alias(k) for k, v in m.items()])
    return flat.join(F.broadcast(ranking_metrics(scores, cohort)), list(cohort))  # one row per cohort


def threshold_sweep(scores: DataFrame, cohort: Sequence[str], thresholds: Sequence[float] = SWEEP_THRESHOLDS) -> DataFrame:
    """Precision, recall, F1, false-positive rate and Youden's J at each threshold.

    A score is reduced to the number of thresholds it reaches; only those few counts per cohort are
    spread over the thresholds. ``scores`` are a score table or, at one shuffle less, ``outcome_rows``.
    """
    cuts = sorted(float(t) for t in thresholds)
    reached = sum((F.col("score") >= t).cast("int") for t in cuts)
    steps = scores.groupBy(*cohort, reached.alias("reached")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    at = F.posexplode(F.array(*[F.lit(t) for t in cuts])).alias("pos_in_list", "threshold")
    hit = F.col("reached") > F.col("pos_in_list")
    counts = (
        steps.select("*", at)
        .groupBy(*cohort, "threshold")
        .agg(
            F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
            F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
            F.sum("pos").alias("p"),
            F.sum("neg").alias("n"),
        )
    )
    tp, fp, p, n = (F.col(c) for c in ("tp", "fp", "p", "n"))
    return counts.select(
        *cohort,
        "threshold",
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, p).alias("recall"),
        ratio(2 * tp, tp + fp + p).alias("f1"),
        ratio(fp, n).alias("fpr"),
        (ratio(tp, p) - ratio(fp, n)).alias("youden_j"),
    )


def best_threshold(sweep: DataFrame, cohort: Sequence[str], metric: str = "youden_j") -> DataFrame:
    """The lowest threshold that reaches the best value of ``metric``."""
    if metric not in SWEEP_METRICS:
        raise ValueError(f"metric must be one of {SWEEP_METRICS}, got {metric!r}")
    best = F.max_by(F.struct("threshold", metric), F.struct(F.col(metric), -F.col("threshold"))).alias("best")
    return sweep.groupBy(*cohort).agg(best).select(
        *cohort, F.col("best.threshold").alias("best_threshold"), F.col(f"best.{metric}").alias("best_value")
    )
