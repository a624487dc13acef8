"""Goldens, invariants and a brute-force comparison of the one-pass features."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators import features
from tidemark.operators.calendar import known_coverage, labelled_calendar, scoring_calendar, snapshot_calendar
from tidemark.params import FEATURES, LABEL, SnapshotPlan

PLAN = SnapshotPlan()


def test_small_goldens(spark, small):
    rows = rows_of(features.training_dataset(small, snapshot_calendar(spark, PLAN, 1)), "CustomerID")
    one, two = rows
    assert (one[LABEL], two[LABEL]) == (1, 0)  # a return alone is not activity
    assert one["total_sales_revenue"] == 35.75 and one["total_items_purchased"] == 4 and one["total_sale_txs"] == 2
    assert one["avg_sale_days"] == 69 and one["recency"] == 59 and one["tenure_days"] == 127
    assert one["total_return_amount"] == 22.25 and one["total_items_returned"] == one["total_return_txs"] == 1 and one["avg_return_days"] == 0
    assert one["recent_revenue"] == 22.25 and one["revenue_momentum"] == pytest.approx(8.75 / 35.75) and one["tx_count_momentum"] == 0
    assert two["total_sales_revenue"] == two["recent_revenue"] == 18 and two["recency"] == 63 and two["tenure_days"] == 62
    assert two["avg_sale_days"] is None and two["revenue_momentum"] == two["tx_count_momentum"] == two["recent_tx_count"] == 1


def test_small_amounts_and_fractions_count(spark, lines):
    tx = lines([(str(i), "A", 0.5, "2010-01-05 10:00", 0.00008, 1) for i in range(3)] + [("9", "A", 1, "2010-01-06 10:00", 3e15, 1)])
    row = features.customer_features(tx.where("Invoice <> '9'"), snapshot_calendar(spark, PLAN, 1)).first()
    assert row.total_sales_revenue == pytest.approx(0.00012, abs=1e-15) and row.total_items_purchased == 1.5
    assert features.customer_features(tx, snapshot_calendar(spark, PLAN, 1)).first().total_sales_revenue == 3e15


def test_midpoint_of_window(spark):
    assert snapshot_calendar(spark, PLAN, 1).first().midpoint == datetime(2010, 2, 14, 12)


def test_training_and_scoring_agree(spark, small):
    train = features.training_dataset(small, snapshot_calendar(spark, PLAN, 1)).drop(LABEL, "snapshot_no")
    as_of = spark.createDataFrame([(date(2010, 5, 1),)], "as_of date")
    score = features.scoring_dataset(small, scoring_calendar(as_of, PLAN))
    assert train.columns == score.columns
    assert rows_of(train, "CustomerID") == rows_of(score, "CustomerID")


def test_future_lines_change_nothing(spark, small, lines):
    cal = snapshot_calendar(spark, PLAN, 1)
    later = lines([("999", "Z", 50, "2010-05-01 00:00", 9.0, 31), ("998", "Z", -7, "2010-07-01 09:00", 3.0, 58)])
    before = rows_of(features.customer_features(small, cal), "CustomerID")
    assert rows_of(features.customer_features(small.unionByName(later), cal), "CustomerID") == before


def messy(seed: int, n: int = 400):
    """Lines that share invoices across times, customers and the midpoint; one customer holds a third."""
    rng = random.Random(seed)
    start = datetime(2009, 12, 1)
    rows = []
    for _ in range(n):
        customer = 1 if rng.random() < 0.34 else rng.randint(2, 12)
        when = start + timedelta(minutes=rng.randrange(0, 330 * 24 * 60))
        if rng.random() < 0.3:
            when = when.replace(hour=rng.choice([0, 11, 12, 23]), minute=rng.choice([0, 59]))
        invoice = rng.choice([None, "H", str(rng.randint(1, 60)), str(rng.randint(1, 60))])
        rows.append((invoice, rng.choice("ABC"), rng.choice([-3, -1, 0, 1, 2, 5]), when, rng.randint(1, 900) / 100, customer))
    return rows


def brute_force(rows, start, mid, end, out_end):
    """The definitions applied to one window, row by row in pandas."""
    df = pd.DataFrame(rows, columns=["inv", "stock", "q", "d", "p", "c"])
    w = df[(df.d >= start) & (df.d < end)]
    out = {}
    for c in sorted(w.c.unique()):
        f = {}
        mine, hist = w[w.c == c], df[(df.c == c) & (df.q > 0) & (df.d < end)]
        s, r = mine[mine.q > 0], mine[mine.q < 0]

        def gap(x):
            u = x[["inv", "d"]].drop_duplicates().sort_values("d")
            g = u["d"].diff().dt.days.mean()
            return None if pd.isna(g) else g

        f["total_sales_revenue"] = (s.p * s.q).sum()
        f["total_items_purchased"] = s.q.sum()
        f["total_sale_txs"] = s.inv.nunique()
        f["avg_sale_days"] = gap(s)
        f["recency"] = (end - s.d.max().normalize()).days if len(s) else None
        f["total_return_amount"] = (r.p * -r.q).sum()
        f["total_items_returned"] = -r.q.sum()
        f["total_return_txs"] = r.inv.nunique()
        f["avg_return_days"] = gap(r) or 0
        f["tenure_days"] = (end - hist.d.min()).days if len(hist) else None
        early, recent = s[s.d < mid], s[s.d >= mid]
        a, b = (early.p * early.q).sum(), (recent.p * recent.q).sum()
        f["recent_revenue"] = b
        f["revenue_momentum"] = (b - a) / (a + b) if a + b > 0 else 0
        x, y = early.inv.nunique(), recent.inv.nunique()
        f["recent_tx_count"] = y
        f["tx_count_momentum"] = (y - x) / (x + y) if x + y > 0 else 0
        later = df[(df.c == c) & (df.q > 0) & (df.d >= end) & (df.d < out_end)]
        f[LABEL] = 0 if len(later) else 1
        out[c] = f
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_brute_force(spark, lines, seed):
    rows = messy(seed)
    cal = snapshot_calendar(spark, PLAN, 2)
    got = features.training_dataset(lines(rows), cal).collect()
    for w in cal.collect():
        want = brute_force(rows, *[pd.Timestamp(x) for x in (w.feature_start, w.midpoint, w.feature_end, w.outcome_end)])
        mine = {r.CustomerID: r.asDict() for r in got if r.snapshot_no == w.snapshot_no}
        assert sorted(mine) == sorted(want)
        for c, f in want.items():
            for name in (*FEATURES, LABEL):
                if f[name] is None:
                    assert mine[c][name] is None, (c, name)
                else:
                    assert mine[c][name] == pytest.approx(f[name], abs=1e-9), (c, name)


def test_partitioning_changes_nothing(spark, lines):
    tx = lines(messy(9))
    cal = snapshot_calendar(spark, PLAN, 2)
    want = rows_of(features.training_dataset(tx, cal), "snapshot_no", "CustomerID")
    for n in (1, 7):
        shuffled = tx.orderBy(F.xxhash64("Invoice", "InvoiceDate")).repartition(n)
        assert rows_of(features.training_dataset(shuffled, cal), "snapshot_no", "CustomerID") == want


def test_earlier_history_gives_only_first_sales(spark, lines):
    tx = lines(messy(5))
    cal = snapshot_calendar(spark, PLAN, 2).where("snapshot_no = 2")
    start = F.lit("2010-03-01").cast("timestamp_ntz")
    want = rows_of(features.training_dataset(tx, cal), "CustomerID")
    parted = features.training_dataset(tx.where(F.col("InvoiceDate") >= start), cal, tx.where(F.col("InvoiceDate") < start))
    assert rows_of(parted, "CustomerID") == want


def test_presence_without_sales_stays_in_the_cohort(spark, lines):
    tx = lines([("1", "A", 0, "2010-01-01 08:00", 1.0, 5), ("2", "A", -1, "2010-01-02 08:00", 1.0, 6)])
    rows = rows_of(features.training_dataset(tx, snapshot_calendar(spark, PLAN, 1)), "CustomerID")
    assert [r["CustomerID"] for r in rows] == [5, 6]
    assert all(r["recency"] is None and r["tenure_days"] is None and r["avg_sale_days"] is None for r in rows)
    assert rows[1]["total_items_returned"] == 1 and rows[0]["total_sales_revenue"] == 0


def test_day_unit_windows(spark, lines):
    plan = SnapshotPlan(start=date(2024, 1, 1), feature=10, outcome=5, step=5, unit="day")
    tx = lines([("1", "A", 1, "2024-01-03 10:00", 2.0, 1), ("2", "A", 1, "2024-01-05 09:00", 2.0, 1)])
    cal = labelled_calendar(known_coverage(spark, datetime(2024, 1, 21)), plan)
    rows = rows_of(features.training_dataset(tx, cal), "snapshot_no")
    assert [r["snapshot_no"] for r in rows] == [1]
    # Two calendar days apart, one elapsed day: gaps count elapsed days, recency calendar days.
    assert rows[0]["avg_sale_days"] == 1 and rows[0]["recency"] == 6


def test_purchase_intervals(lines):
    tx = lines(
        [("1", "A", 1, "2010-01-01 10:00", 1.0, 1), ("2", "A", 1, "2010-01-11 10:00", 1.0, 1), ("3", "A", 1, "2010-01-31 09:00", 1.0, 1),
         ("4", "A", 1, "2010-01-01 10:00", 1.0, 2)]
    )
    got = {r.CustomerID: r.avg_days_between_purchases for r in features.purchase_intervals(tx).collect()}
    assert got == {1: 14.5, 2: None}
