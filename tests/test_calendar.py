from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows_of

from tidemark.operators import calendar as cal
from tidemark.params import SnapshotPlan, SplitPlan

PLAN = SnapshotPlan()


def cover(spark, when):
    return cal.known_coverage(spark, datetime.fromisoformat(when))


def test_windows_are_chained(spark):
    rows = rows_of(cal.snapshot_calendar(spark, PLAN, 3), "snapshot_no")
    assert [r["feature_start"] for r in rows] == [datetime(2009, 12, 1), datetime(2010, 3, 1), datetime(2010, 6, 1)]
    assert rows[0]["feature_end"] == rows[0]["outcome_start"] == datetime(2010, 5, 1)
    assert rows[0]["outcome_end"] == datetime(2010, 8, 1)


def test_available_counts_only_whole_outcomes(spark):
    count = lambda when: cal.available_snapshots(cover(spark, when), PLAN).first().available
    assert count("2010-07-31T23:59:00") == 0
    assert count("2010-08-01T00:00:00") == 1
    assert count("2011-10-01T00:00:00") == 5


def test_step_recommendation_stops_at_the_first_misfit(spark):
    rows = rows_of(cal.step_recommendation(cover(spark, "2011-10-01T00:00:00"), PLAN, 5), "step")
    assert [r["available"] for r in rows[:4]] == [15, 8, 5, 4]
    assert [r["step"] for r in rows if r["recommended"]] == [3]
    none = rows_of(cal.step_recommendation(cover(spark, "2010-08-01T00:00:00"), PLAN, 5), "step")
    assert [r["step"] for r in none if r["recommended"]] == [1]


@pytest.mark.parametrize(
    "latest,want",
    [(7, [[1, 2, 3, 4], [5], [6, 7]]), (9, [[3, 4, 5, 6], [7], [8, 9]]), (13, [[7, 8, 9, 10], [11], [12, 13]])],
)
def test_rolling_split(spark, latest, want):
    split = SplitPlan(4, 1, 2)
    assert list(cal.split_numbers(latest, split).values()) == want
    rows = rows_of(cal.rolling_split(cal.snapshot_calendar(spark, PLAN, latest), split), "snapshot_no")
    got = {s: [r["snapshot_no"] for r in rows if r["split"] == s] for s in ("train", "val", "test")}
    assert list(got.values()) == want


def test_split_needs_enough_snapshots(spark):
    with pytest.raises(ValueError):
        cal.split_numbers(3, SplitPlan())
    with pytest.raises(ValueError):
        cal.require_split(4, SplitPlan(), end_snapshot=5)
    assert cal.rolling_split(cal.snapshot_calendar(spark, PLAN, 3), SplitPlan()).isEmpty()


def test_fixed_split(spark):
    rows = rows_of(cal.fixed_split(cal.snapshot_calendar(spark, PLAN, 9), SplitPlan()), "snapshot_no")
    assert [r["split"] for r in rows] == ["train", "train", "val", "test"]


def test_forward_folds(spark):
    ids = spark.createDataFrame([(2,), (2,), (3,), (3,), (4,), (4,)], "snapshot_no int")
    rows = rows_of(cal.forward_folds(ids), "fold", "role", "snapshot_no")
    folds = [(r["fold"], r["role"], r["snapshot_no"]) for r in rows]
    assert folds == [(1, "train", 2), (1, "validate", 3), (2, "train", 2), (2, "train", 3), (2, "validate", 4)]
    assert cal.forward_folds(ids.limit(1)).isEmpty()


def test_end_of_month_is_clipped(spark):
    dates = spark.createDataFrame([(date(2011, 7, 31),)], "as_of date")
    assert cal.scoring_calendar(dates, PLAN).first().feature_start == datetime(2011, 2, 28)


def test_cadence(spark):
    dates = spark.createDataFrame([(date(2011, m, 1),) for m in (8, 9, 10, 12)], "as_of date")
    from pyspark.sql import functions as F

    first, anchor = F.lit("2011-06-01").cast("date"), F.lit("2011-09-01").cast("date")
    rows = rows_of(cal.cadence_gates(dates, first, anchor), "as_of")
    assert [r["delayed_evaluation_due"] for r in rows] == [False, True, True, True]
    assert [r["retrain_due"] for r in rows] == [False, True, False, True]


def test_readiness(spark):
    status = spark.createDataFrame([(3, None), (5, 5), (5, 4), (5, None)], "available int, champion_latest_snapshot int")
    reasons = lambda **k: [r.reason for r in cal.retrain_readiness(status, SplitPlan(), **k).collect()]
    assert reasons() == ["not_enough_snapshots", "no_new_snapshot", None, None]
    assert reasons(force=True) == ["not_enough_snapshots", None, None, None]


def test_coverage_prefers_the_manifest(spark, small):
    schema = "status string, snapshot_date string"
    some = spark.createDataFrame([("SUCCESS", "2010-07-01"), ("FAILED", "2010-09-01")], schema)
    assert cal.manifest_coverage(some, small).first().coverage_end == datetime(2010, 7, 1)
    none = spark.createDataFrame([], schema)
    assert cal.manifest_coverage(none, small).first().coverage_end == datetime(2010, 7, 31, 23, 30)
