"""Outcome labels of scored or training cohorts: did a sale follow within the outcome window?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.temporal import day_of, midnight, shift
from tidemark.params import LABEL, SnapshotPlan

KEYS = ("snapshot_date", "CustomerID")


def outcome_windows(cohorts: DataFrame, plan: SnapshotPlan = SnapshotPlan()) -> DataFrame:
    """``snapshot_date, outcome_start, outcome_end`` of the distinct cohorts, one row per date."""
    start = midnight(F.col("snapshot_date"))
    return (
        cohorts.select(F.col("snapshot_date").cast("date").alias("snapshot_date"))
        .distinct()
        .select("snapshot_date", start.alias("outcome_start"), shift(start, plan.outcome, plan.unit).alias("outcome_end"))
    )


def active_customers(tx: DataFrame, windows: DataFrame) -> DataFrame:
    """Distinct (snapshot_date, CustomerID) with a sale in the outcome window.

    Returns and zero-quantity lines do not count. The windows expand to their days: a day belongs to
    at most a few windows, so the broadcast is as small as the calendar.
    """
    days = windows.select(
        "snapshot_date",
        F.explode(F.sequence(day_of(F.col("outcome_start")), F.date_sub(day_of(F.col("outcome_end")), 1))).alias("day"),
    )
    sales = tx.where(F.col("Quantity") > 0).select("CustomerID", day_of(F.col("InvoiceDate")).alias("day"))
    return sales.join(F.broadcast(days), "day").select(*KEYS).distinct()


def outcome_labels(
    cohort: DataFrame,
    tx: DataFrame,
    plan: SnapshotPlan = SnapshotPlan(),
    windows: DataFrame | None = None,
    resolved_at: str | None = None,
) -> DataFrame:
    """One label per scored customer and snapshot: 1 when no sale followed.

    Cohort and sales meet in one aggregation instead of a join, so repeated ids combine on the map
    side. Pass ``windows`` when the cohort dates are known to spare a pass over the cohort.
    """
    windows = outcome_windows(cohort, plan) if windows is None else windows
    member = cohort.select(F.col("snapshot_date").cast("date").alias("snapshot_date"), "CustomerID")
    seen = member.select(*KEYS, F.lit(1).alias("member"), F.lit(0).alias("active")).unionByName(
        active_customers(tx, windows).select(*KEYS, F.lit(0).alias("member"), F.lit(1).alias("active"))
    )
    start = midnight(F.col("snapshot_date"))
    return (
        seen.groupBy(*KEYS)
        .agg(F.max("member").alias("member"), F.max("active").alias("active"))
        .where(F.col("member") == 1)
        .select(
            *KEYS,
            start.alias("outcome_start"),
            shift(start, plan.outcome, plan.unit).alias("outcome_end"),
            (1 - F.col("active")).alias(LABEL),
            F.lit(resolved_at).cast("string").alias("resolved_at"),
        )
    )


def upsert_labels(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Per (snapshot, customer) the label resolved last; an incoming row wins a tie.

    ``max_by`` keeps one row per key while combining, so repeated resolutions never gather in a task.
    """
    rest = [c for c in incoming.columns if c not in KEYS]
    both = stored.withColumn("newer", F.lit(0)).unionByName(incoming.withColumn("newer", F.lit(1)))
    last = F.max_by(F.struct(*rest), F.struct("resolved_at", "newer")).alias("last")
    return both.groupBy(*KEYS).agg(last).select(*KEYS, "last.*")
