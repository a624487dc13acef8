"""Turning probabilities into prediction rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import risk_tier
from tidemark.functions.temporal import midnight, shift
from tidemark.params import SnapshotPlan


def align_features(df: DataFrame, expected: Sequence[str], keys: Sequence[str] = (), exact_order: bool = False) -> DataFrame:
    """The expected features in the expected order; any missing or extra column is an error.

    ``exact_order`` also refuses columns that arrive in another order.
    """
    have = [c for c in df.columns if c not in keys]
    missing = [c for c in expected if c not in have]
    extra = [c for c in have if c not in expected]
    if missing or extra:
        raise ValueError(f"feature schema mismatch: missing={missing}, extra={extra}")
    if exact_order and have != list(expected):
        raise ValueError(f"feature order mismatch: expected={list(expected)}, actual={have}")
    return df.select(*keys, *expected)


def score_projection(
    scored: DataFrame,
    threshold: Column | float,
    *,
    model_type: Column | str,
    model_version: Column | str,
    role: Column | str = "official",
    run_id: str | None = None,
    scored_at: str | None = None,
    plan: SnapshotPlan = SnapshotPlan(),
    extra: Sequence[str] = (),
) -> DataFrame:
    """Prediction rows from ``CustomerID, snapshot_date, churn_probability``. The threshold is inclusive."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    start = midnight(F.col("snapshot_date"))
    p = F.col("churn_probability")
    t = lit(threshold).cast("double")
    return scored.select(
        "CustomerID",
        "snapshot_date",
        start.alias("outcome_start"),
        shift(start, plan.outcome, plan.unit).alias("outcome_end"),
        p,
        (p >= t).cast("int").alias("predicted_churn"),
        risk_tier(p).alias("risk_tier"),
        lit(model_type).alias("model_type"),
        lit(model_version).alias("model_version"),
        lit(role).alias("prediction_role"),
        t.alias("threshold_used"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(scored_at).cast("string").alias("scored_at"),
        *extra,
    )


def scoring_summary(predictions: DataFrame, cohort: Sequence[str] = ("snapshot_date", "model_version", "prediction_role")) -> DataFrame:
    """Active customers, mean probability, predicted rate and the tier counts of each scoring run."""
    tier = lambda t: F.count_if(F.col("risk_tier") == t)
    return predictions.groupBy(*cohort).agg(
        F.count("*").alias("active_customers"),
        F.avg("churn_probability").alias("mean_churn_probability"),
        F.avg("predicted_churn").alias("predicted_churn_rate"),
        F.max("threshold_used").alias("threshold"),
        tier("low").alias("low_risk"),
        tier("medium").alias("medium_risk"),
        tier("high").alias("high_risk"),
    )


def history_summary(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: time range of the clean history, raw and clean row counts."""
    a = raw.agg(F.count("*").alias("raw_rows"), F.lit(None).cast("timestamp_ntz").alias("history_min"))
    b = clean.agg(
        F.count("*").alias("clean_rows"),
        F.min("InvoiceDate").alias("history_min"),
        F.max("InvoiceDate").alias("history_max"),
    )
    return a.unionByName(b, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("raw_rows", "clean_rows", "history_min", "history_max")]
    )


def hashed_order(*cols: str, seed: int) -> Column:
    """A seeded pseudo-random order that depends on the row's keys alone."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def reference_sample(df: DataFrame, n: int | None, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in hashed key order: the baseline saved with a model, the same on every rerun.

    Counting the hash prefixes first (at most 65,536) tells where the n-th row lies, so that the final
    sort sees little more than the sample, however many tasks hold the rows. Without ``n`` all rows stay.
    """
    if n is None:
        return df
    rows = df.withColumn("sample_key", hashed_order(*keys, seed=seed)).withColumn("prefix", F.substring("sample_key", 1, 4))
    upto = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("prefix").agg(F.count("*").alias("size"))
    wanted = sizes.withColumn("before", F.coalesce(F.sum("size").over(upto), F.lit(0))).where(F.col("before") < n).select("prefix")
    return rows.join(F.broadcast(wanted), "prefix", "left_semi").orderBy("sample_key", *keys).limit(n).drop("prefix")


def group_folds(df: DataFrame, k: int, customer: str = "CustomerID", seed: int = 42) -> DataFrame:
    """``fold`` 0..k-1 that keeps all rows of a customer together."""
    part = F.conv(F.substring(hashed_order(customer, seed=seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("fold", F.pmod(part, F.lit(k)).cast("int"))
