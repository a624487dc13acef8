"""Promotion guardrails and monitoring alerts as conditional columns over metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.params import TEMPORAL_FEATURES, AlertPolicy, GuardrailPolicy

# Severity order of the alert states; the two states without a comparison rank as OK.
SEVERITY = {"OK": 0, "NOT_AVAILABLE": 0, "NOT_COMPARABLE": 0, "WARNING": 1, "CRITICAL": 2}
REFERENCE_METRICS = ("roc_auc", "recall", "brier_score")


def promotion_decision(pairs: DataFrame, policy: GuardrailPolicy = GuardrailPolicy()) -> DataFrame:
    """Challenger against champion on one cohort per row.

    ``pairs`` has ``challenger_<m>`` and ``champion_<m>`` for the primary metric, recall and Brier score.
    A missing recall or Brier score does not block, it is flagged as not evaluated. The strict variant
    of the rule (a missing value fails) is ``strict_promote``.
    """
    delta = lambda m: F.col(f"challenger_{m}") - F.col(f"champion_{m}")
    df = (
        pairs.withColumn("primary_delta", delta(policy.metric))
        .withColumn("recall_delta", delta("recall"))
        .withColumn("brier_delta", delta("brier_score"))
    )
    flags = {
        "primary_pass": F.col("primary_delta") >= -policy.max_metric_regression,
        "recall_pass": F.col("recall_delta") >= -policy.max_recall_regression,
        "brier_pass": F.col("brier_delta") <= policy.max_brier_regression,
    }
    names = {"primary_pass": policy.metric, "recall_pass": "recall", "brier_pass": "brier_score"}
    for k, v in flags.items():
        df = df.withColumn(k, v)
    failed = F.filter(
        F.array(*[F.when(~F.col(k), F.lit(n)) for k, n in names.items()]), lambda x: x.isNotNull()
    )
    ok = lambda k: F.coalesce(F.col(k), F.lit(True))
    # The primary metric must exist on both sides; the two others may be missing.
    promote = F.coalesce(F.col("primary_pass"), F.lit(False)) & ok("recall_pass") & ok("brier_pass")
    strict = F.coalesce(F.col("primary_pass") & F.col("recall_pass") & F.col("brier_pass"), F.lit(False))
    return (
        df.withColumn("not_evaluated", F.col("recall_delta").isNull() | F.col("brier_delta").isNull())
        .withColumn("promote", promote)
        .withColumn("strict_promote", strict)
        .withColumn("failed_checks", F.concat_ws(",", failed))
        .withColumn("reason", F.when(F.col("promote"), "promoted").otherwise(F.concat(F.lit("blocked: "), F.col("failed_checks"))))
    )


def resolve_reference(metadata: DataFrame, sources: Sequence[str] = ("test_metrics", "validation_metrics", "metrics")) -> DataFrame:
    """The first metric struct that has any of the reference metrics, with its name."""

    def filled(s: str) -> Column:
        return F.coalesce(*[F.col(f"{s}.{m}") for m in REFERENCE_METRICS]).isNotNull()

    present = [s for s in sources if s in metadata.columns]
    source = F.coalesce(*[F.when(filled(s), F.lit(s)) for s in present])
    picked = [
        F.coalesce(*[F.when(F.col("reference_source") == s, F.col(f"{s}.{m}")) for s in present]).alias(f"reference_{m}")
        for m in REFERENCE_METRICS
    ]
    return metadata.withColumn("reference_source", source).select("*", *picked)


def behavioral_psi(summary: DataFrame, report: DataFrame, key: str) -> DataFrame:
    """``max_behavioral_feature_psi`` of the run summary, else the report's largest non-temporal PSI."""
    found = report.where(~F.col("feature").isin(*TEMPORAL_FEATURES)).groupBy(key).agg(F.max("psi").alias("report_psi"))
    return (
        summary.join(F.broadcast(found), key, "left")
        .withColumn("max_behavioral_feature_psi", F.coalesce(F.col("max_behavioral_feature_psi"), F.col("report_psi")))
        .drop("report_psi")
    )


def _level(value: Column, warning: float, critical: float) -> Column:
    """Both limits are inclusive."""
    return (
        F.when(value.isNull(), "NOT_AVAILABLE").when(value >= critical, "CRITICAL").when(value >= warning, "WARNING").otherwise("OK")
    )


def alert_signals(runs: DataFrame, key: str = "snapshot_date", policy: AlertPolicy = AlertPolicy()) -> DataFrame:
    """Long table of signals per monitored run.

    ``runs`` has ``prediction_psi, max_behavioral_feature_psi``; the delayed metrics ``roc_auc, recall,
    brier_score`` with ``reference_*``; ``model_lineage`` (NULL counts as the same model),
    ``reference_model`` and ``evaluated`` (false when no delayed evaluation exists).
    """
    same = F.col("model_lineage").isNull() | (F.col("model_lineage") == F.col("reference_model"))
    d = F.lit(None).cast("double")

    def signal(name: str, status: Column, current: Column, ref: Column, regression: Column, warn: float, crit: float, way: str, when: Column):
        fields = F.struct(
            F.lit(name).alias("signal"),
            status.alias("status"),
            current.cast("double").alias("current_value"),
            ref.cast("double").alias("reference_value"),
            regression.cast("double").alias("regression"),
            F.lit(warn).alias("warning_limit"),
            F.lit(crit).alias("critical_limit"),
            F.lit(way).alias("direction"),
        )
        return F.when(when, fields)

    def high(name: str, warn: float, crit: float) -> Column:
        v = F.col(name)
        return signal(name, _level(v, warn, crit), v, d, d, warn, crit, "higher_is_worse", F.lit(True))

    def regression(name: str, metric: str, drop: float, way: str) -> Column:
        cur, ref = F.col(metric), F.col(f"reference_{metric}")
        worse = (ref - cur) if way == "higher_is_better" else (cur - ref)
        crit = drop * policy.critical_multiplier
        return signal(name, _level(worse, drop, crit), cur, ref, worse, drop, crit, way, F.col("evaluated") & same)

    other = signal(
        "delayed_performance_reference", F.lit("NOT_COMPARABLE"), d, d, d, None, None, None, F.col("evaluated") & ~same
    )
    signals = F.array(
        high("prediction_psi", policy.prediction_psi_warning, policy.prediction_psi_critical),
        high("max_behavioral_feature_psi", policy.feature_psi_warning, policy.feature_psi_critical),
        regression("delayed_roc_auc_regression", "roc_auc", policy.max_roc_auc_drop, "higher_is_better"),
        regression("delayed_recall_regression", "recall", policy.max_recall_drop, "higher_is_better"),
        regression("delayed_brier_worsening", "brier_score", policy.max_brier_worsening, "lower_is_better"),
        _typed(other, d),
    )
    return runs.select(key, F.inline(F.filter(signals, lambda s: s.isNotNull())))


def _typed(s: Column, d: Column) -> Column:
    """Give the NULL limits and direction of the incomparable signal the types of the others."""
    return s.cast(
        "struct<signal:string,status:string,current_value:double,reference_value:double,regression:double,"
        "warning_limit:double,critical_limit:double,direction:string>"
    )


def alert_rollup(signals: DataFrame, key: str = "snapshot_date") -> DataFrame:
    """Overall state per run, with the counts and names of its warnings and critical signals.

    A run has at most six signals, so the lists are bounded.
    """
    rank = F.coalesce(*[F.when(F.col("status") == s, F.lit(r)) for s, r in SEVERITY.items()], F.lit(0))
    named = lambda s: F.concat_ws(",", F.sort_array(F.collect_list(F.when(F.col("status") == s, F.col("signal")))))
    worst = F.max(rank)
    return signals.groupBy(key).agg(
        F.when(worst == 2, "CRITICAL")
        .when(worst == 1, "WARNING")
        # Without a warning the first signal speaks for the run.
        .otherwise(F.coalesce(F.max(F.when(F.col("signal") == "prediction_psi", F.col("status"))), F.lit("OK")))
        .alias("overall_status"),
        F.count_if(F.col("status") == "WARNING").alias("warning_count"),
        F.count_if(F.col("status") == "CRITICAL").alias("critical_count"),
        named("WARNING").alias("warning_signals"),
        named("CRITICAL").alias("critical_signals"),
    )
