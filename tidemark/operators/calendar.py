"""Snapshot calendars, splits, folds and cadence: planning tables derived from the data's coverage.

Every table here has a handful of rows per month of history, whatever the volume of facts. That is the
size bound behind each broadcast of a calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.temporal import day_of, midnight, moment, month_index, shift
from tidemark.params import SnapshotPlan, SplitPlan


def coverage_of(tx: DataFrame) -> DataFrame:
    """One row: the last event time, up to which outcomes count as known."""
    return tx.agg(F.max("InvoiceDate").alias("coverage_end"))


def known_coverage(spark: SparkSession, coverage_end) -> DataFrame:
    """A declared boundary as the one-row table the calendars take. It costs no scan of the facts."""
    return spark.range(0, 1, 1, 1).select(moment(coverage_end).alias("coverage_end"))


def manifest_coverage(manifest: DataFrame, tx: DataFrame) -> DataFrame:
    """The boundary of the newest loaded batch, or the last event time when nothing is recorded."""
    recorded = manifest.where(F.col("status") == "SUCCESS").agg(
        F.max(F.to_date("snapshot_date")).cast("timestamp_ntz").alias("coverage_end")
    )
    events = coverage_of(tx)
    return (
        recorded.withColumn("preference", F.lit(0))
        .unionByName(events.withColumn("preference", F.lit(1)))
        .where(F.col("coverage_end").isNotNull())
        .agg(F.min_by("coverage_end", "preference").alias("coverage_end"))
    )


def _windows(numbered: DataFrame, plan: SnapshotPlan, step: Column | None = None) -> DataFrame:
    """Boundaries of the snapshots in ``snapshot_no``."""
    u = plan.unit
    start = midnight(F.lit(plan.start.isoformat()).cast("date"))
    hop = F.lit(plan.step) if step is None else step
    df = numbered.withColumn("feature_start", shift(start, (F.col("snapshot_no") - 1) * hop, u))
    df = df.withColumn("feature_end", shift(F.col("feature_start"), plan.feature, u))
    df = df.withColumn("midpoint", (F.col("feature_start") + (F.col("feature_end") - F.col("feature_start")) / 2).cast("timestamp_ntz"))
    df = df.withColumn("outcome_start", F.col("feature_end"))
    return df.withColumn("outcome_end", shift(F.col("outcome_start"), plan.outcome, u))


def _units_between(plan: SnapshotPlan, end: Column) -> Column:
    """Upper bound of whole units from the plan's start to ``end``."""
    start = F.lit(plan.start.isoformat()).cast("date")
    if plan.unit == "month":
        return month_index(day_of(end)) - month_index(start) + 1
    return F.datediff(day_of(end), start) + 1


def _candidates(coverage: DataFrame, plan: SnapshotPlan, step: Column) -> DataFrame:
    """Numbers 1..k of all snapshots that start by the coverage end."""
    k = F.floor(_units_between(plan, F.col("coverage_end")) / step).cast("int") + 1
    return coverage.where(k >= 1).withColumn("snapshot_no", F.explode(F.sequence(F.lit(1), k)))


def snapshot_calendar(spark: SparkSession, plan: SnapshotPlan, n: int) -> DataFrame:
    """The first ``n`` snapshot windows."""
    return _windows(spark.range(1, n + 1, 1, 1).select(F.col("id").cast("int").alias("snapshot_no")), plan)


def labelled_calendar(coverage: DataFrame, plan: SnapshotPlan) -> DataFrame:
    """Every snapshot whose whole outcome window lies within the coverage."""
    return (
        _windows(_candidates(coverage, plan, F.lit(plan.step)), plan)
        .where(F.col("outcome_end") <= F.col("coverage_end"))
        .drop("coverage_end")
    )


def scorable_calendar(coverage: DataFrame, plan: SnapshotPlan) -> DataFrame:
    """Every snapshot whose feature window lies within the coverage, labelled or not."""
    return (
        _windows(_candidates(coverage, plan, F.lit(plan.step)), plan)
        .where(F.col("feature_end") <= F.col("coverage_end"))
        .drop("coverage_end")
    )


def scoring_calendar(dates: DataFrame, plan: SnapshotPlan) -> DataFrame:
    """Trailing feature windows of arbitrary ``as_of`` dates; no outcome."""
    end = midnight(F.col("as_of"))
    start = shift(end, -plan.feature, plan.unit)
    return dates.select("as_of").distinct().select(
        F.date_format("as_of", "yyyyMMdd").cast("int").alias("snapshot_no"),
        start.alias("feature_start"),
        end.alias("feature_end"),
        (start + (end - start) / 2).cast("timestamp_ntz").alias("midpoint"),
        end.alias("outcome_start"),
        end.alias("outcome_end"),
    )


def available_snapshots(coverage: DataFrame, plan: SnapshotPlan) -> DataFrame:
    """One row: the coverage end and the number of fully labelled snapshots."""
    cal = _windows(_candidates(coverage, plan, F.lit(plan.step)), plan)
    fits = F.col("outcome_end") <= F.col("coverage_end")
    return cal.groupBy("coverage_end").agg(
        F.coalesce(F.max(F.when(fits, F.col("snapshot_no"))), F.lit(0)).alias("available")
    )


def step_recommendation(coverage: DataFrame, plan: SnapshotPlan, total: int, max_step: int = 12) -> DataFrame:
    """Per step 1..max_step the labelled snapshots it leaves, and the largest step that still fits.

    The recommended step ends the unbroken run of fitting steps from 1, and is 1 if none fits.
    """
    steps = coverage.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(max_step))))
    cal = _windows(_candidates(steps, plan, F.col("step")), plan, F.col("step"))
    per_step = cal.groupBy("step").agg(
        F.coalesce(
            F.max(F.when(F.col("outcome_end") <= F.col("coverage_end"), F.col("snapshot_no"))), F.lit(0)
        ).alias("available")
    )
    fits = F.col("available") >= total
    all_steps = Window.partitionBy()  # max_step rows
    run = F.coalesce(F.min(F.when(~fits, F.col("step"))).over(all_steps) - 1, F.lit(max_step))
    return per_step.select(
        "step", "available", fits.alias("fits"), (F.col("step") == F.greatest(run, F.lit(1))).alias("recommended")
    )


def rolling_split(calendar: DataFrame, split: SplitPlan, end_snapshot: int | None = None) -> DataFrame:
    """``snapshot_no, split`` of the rolling window that ends at the newest labelled snapshot.

    Empty when there are fewer snapshots than the split needs, see :func:`require_split`.
    """
    w = Window.partitionBy()  # the calendar is a planning table of a few rows
    latest = F.max("snapshot_no").over(w) if end_snapshot is None else F.lit(end_snapshot)
    back = F.col("latest") - F.col("snapshot_no")
    return (
        calendar.select("snapshot_no")
        .withColumn("latest", latest)
        .where((back >= 0) & (back < split.total) & (F.col("latest") >= split.total))
        .select("snapshot_no", _split_name(split.total - 1 - back, split).alias("split"))
    )


def fixed_split(calendar: DataFrame, split: SplitPlan) -> DataFrame:
    """``snapshot_no, split`` counted from snapshot 1; empty when there are too few snapshots."""
    pos = F.col("snapshot_no") - 1
    known = F.max("snapshot_no").over(Window.partitionBy())
    return (
        calendar.select("snapshot_no", known.alias("known"))
        .where((pos < split.total) & (F.col("known") >= split.total))
        .select("snapshot_no", _split_name(pos, split).alias("split"))
    )


def _split_name(pos: Column, split: SplitPlan) -> Column:
    return F.when(pos < split.train, "train").when(pos < split.train + split.val, "val").otherwise("test")


def split_numbers(latest: int, split: SplitPlan) -> dict[str, list[int]]:
    """Snapshot numbers per split of a window that ends at ``latest``."""
    first = latest - split.total + 1
    if first < 1:
        raise ValueError(f"need {split.total} snapshots, but the latest is {latest}")
    ids = list(range(first, latest + 1))
    a, b = split.train, split.train + split.val
    return {"train": ids[:a], "val": ids[a:b], "test": ids[b:]}


def require_split(available: int, split: SplitPlan, end_snapshot: int | None = None) -> dict[str, list[int]]:
    latest = available if end_snapshot is None else end_snapshot
    if latest > available:
        raise ValueError(f"snapshot {latest} is not fully labelled; the latest is {available}")
    return split_numbers(latest, split)


def forward_folds(snapshots: DataFrame) -> DataFrame:
    """``fold, role, snapshot_no``: fold i trains on the i oldest snapshots and validates on the next."""
    order = Window.orderBy("snapshot_no")  # distinct snapshot numbers: a planning table
    numbered = snapshots.select("snapshot_no").distinct().withColumn("pos", F.row_number().over(order))
    numbered = numbered.withColumn("n", F.count("*").over(Window.partitionBy()))
    fold = F.explode(F.sequence(F.greatest(F.col("pos") - 1, F.lit(1)), F.col("n") - 1))
    return (
        numbered.where(F.col("n") >= 2)
        .withColumn("fold", fold)
        .select(
            "fold",
            F.when(F.col("fold") == F.col("pos") - 1, "validate").otherwise("train").alias("role"),
            "snapshot_no",
        )
    )


def cadence_gates(dates: DataFrame, first_prediction, retrain_anchor, outcome: int = 3, every: int = 3) -> DataFrame:
    """Per ``as_of`` date: is a delayed evaluation due, is a retrain due (whole months only)."""
    now = month_index(F.col("as_of"))
    first = month_index(first_prediction)
    anchor = month_index(retrain_anchor)
    return dates.select(
        "as_of",
        (now >= first + outcome).alias("delayed_evaluation_due"),
        ((now >= anchor) & ((now - anchor) % every == 0)).alias("retrain_due"),
    )


def retrain_readiness(status: DataFrame, split: SplitPlan, force: bool = False) -> DataFrame:
    """From ``available, champion_latest_snapshot``: is there a new labelled snapshot to train on?

    ``champion_latest_snapshot`` is NULL while no champion exists. ``force`` skips only the second check.
    """
    few = F.col("available") < split.total
    stale = F.coalesce(F.col("available") <= F.col("champion_latest_snapshot"), F.lit(False)) & F.lit(not force)
    return status.withColumn("needed", F.lit(split.total)).withColumn("retrain_skipped", few | stale).withColumn(
        "reason",
        F.when(few, "not_enough_snapshots").when(stale, "no_new_snapshot"),
    )
