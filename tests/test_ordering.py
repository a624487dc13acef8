"""Distributed order statistics against numpy and pandas."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.functions.numeric import BAND_DENSITY, CELL_DENSITY, order_cell
from tidemark.operators.calibration import calibration_deciles, expected_calibration_error
from tidemark.operators.ordering import quantiles, running_totals

POINTS = [0.0, 0.1, 0.25, 0.30000000000000004, 0.5, 0.9, 1.0]


def values(kind: str, rng: random.Random) -> list[float]:
    if kind == "heavy tail":
        return [rng.paretovariate(0.5) - 3 for _ in range(700)]
    if kind == "one value holds a third":
        return [0.25 if rng.random() < 0.34 else rng.random() for _ in range(600)]
    if kind == "negative":
        return [rng.gauss(0, 50) for _ in range(500)]
    if kind == "close together":
        return [0.5 + rng.random() * 1e-9 for _ in range(300)]
    return [7.0]


@pytest.mark.parametrize("kind", ["heavy tail", "one value holds a third", "negative", "close together", "single"])
def test_quantiles_match_numpy(spark, kind):
    v = values(kind, random.Random(kind))
    df = spark.createDataFrame([("g", x) for x in v] + [("g", None)], "g string, v double").repartition(5)
    row = quantiles(df, ["g"], "v", POINTS).first()
    assert row.n == len(v)
    assert row.q == pytest.approx(list(np.quantile(v, POINTS)), rel=1e-12, abs=1e-12)


def test_order_cell_never_decreases(spark):
    rng = random.Random(5)
    v = sorted([rng.uniform(-1e6, 1e6) for _ in range(3000)] + [rng.uniform(-1, 1) for _ in range(3000)] + [0.0, -0.0])
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, v double")
    for density in (BAND_DENSITY, CELL_DENSITY):
        cells = [r.c for r in df.orderBy("i").select(order_cell(F.col("v"), density).alias("c")).collect()]
        assert cells == sorted(cells)
    tiny = spark.range(100_000).select((F.col("id") * 5e-13 + 1e-13).alias("v"))
    cells = tiny.groupBy(order_cell(F.col("v"), CELL_DENSITY).alias("c")).count()
    assert cells.agg(F.max("count")).first()[0] <= 2 and cells.count() > 90_000
    # A band holds CELL_DENSITY / BAND_DENSITY cells.
    per = df.select(order_cell(F.col("v"), CELL_DENSITY).alias("c"), order_cell(F.col("v"), BAND_DENSITY).alias("b")).distinct()
    assert per.groupBy("b").agg(F.max("c") - F.min("c")).agg(F.max("(max(c) - min(c))")).first()[0] <= 2 * CELL_DENSITY // BAND_DENSITY


def test_running_totals(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), round(rng.random(), 2), rng.randint(0, 5)) for _ in range(500)]
    df = spark.createDataFrame(data, "g string, v double, m int").repartition(6)
    for r in running_totals(df, ["g"], ["v"], ["m"]).collect():
        assert r.m_below == sum(m for g, v, m in data if g == r.g and v < r.v)
        assert r.m == sum(m for g, v, m in data if g == r.g and v == r.v)
        assert r.m_total == sum(m for g, v, m in data if g == r.g)


@pytest.mark.parametrize("n,bins,ties", [(1, 10, False), (4, 2, False), (7, 10, False), (103, 10, True), (400, 7, True), (361, 10, False)])
def test_deciles_match_rank_cuts(spark, n, bins, ties):
    rng = random.Random(n)
    score = lambda: rng.choice([0.2, 0.5, 0.8]) if ties else rng.random()
    # Ids spread over several blocks, so a crossing block is a part of a tie.
    data = [(i * 40_000, score(), rng.randint(0, 1)) for i in range(n)]
    df = spark.createDataFrame([("c", *x) for x in data], "c string, CustomerID long, churn_probability double, y int")
    got = rows_of(calibration_deciles(df.repartition(4), ["c"], "y", bins=bins), "risk_decile")
    ref = pd.DataFrame(data, columns=["id", "p", "y"]).sort_values(["p", "id"]).reset_index(drop=True)
    ref["bin"] = pd.qcut(ref.index + 1, q=min(bins, n), labels=False, duplicates="drop") + 1
    want = ref.groupby("bin").agg(n=("y", "size"), p=("p", "mean"), y=("y", "mean"))
    assert [r["risk_decile"] for r in got] == list(want.index)
    assert [r["n"] for r in got] == list(want.n)
    assert [r["mean_predicted_probability"] for r in got] == pytest.approx(list(want.p))
    assert [r["actual_churn_rate"] for r in got] == pytest.approx(list(want.y))
    ece = expected_calibration_error(calibration_deciles(df, ["c"], "y", bins=bins), ["c"]).first().ece
    assert ece == pytest.approx(float(((want.p - want.y).abs() * want.n).sum() / n))


def test_rows_without_a_value_take_no_place(spark):
    """They get no row and count neither below the others nor in the total of the group."""
    df = spark.createDataFrame([("a", 2.0, 1), ("a", 1.0, 1), ("a", 1.0, 3), ("a", None, 7), ("b", None, 5)], "g string, x double, n int")
    got = {(r.g, r.x): (r.n, r.n_below, r.n_total) for r in running_totals(df, ["g"], ["x"], ["n"]).collect()}
    assert got == {("a", 1.0): (4, 0, 5), ("a", 2.0): (1, 4, 5)}
