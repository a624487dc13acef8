"""Shape of the physical plans: what may not appear at scale."""

from __future__ import annotations

import re

import pytest
from conftest import SF

from tidemark.registry.queries import QUERIES


def final_plan(df) -> str:
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_lines_are_read_and_shuffled_once(spark):
    plan = final_plan(QUERIES["training_dataset"](spark, SF))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1
    assert "ReusedExchange" in plan


def test_scan_is_pruned(spark):
    plan = final_plan(QUERIES["training_dataset"](spark, SF))
    schema = re.search(r"ReadSchema: struct<l_orderkey[^>]*>", plan).group()
    assert set(re.findall(r"l_\w+", schema)) == {"l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag"}


FACTS = (
    "training_dataset customer_features monthly_volume structural_quality feature_outcome_split outcome_labels "
    "purchase_interval_summary roc_auc threshold_sweep calibration_deciles prediction_drift clean_transactions"
).split()


@pytest.mark.parametrize("name", FACTS)
def test_no_row_multiplication_or_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", FACTS)
def test_windows_are_partitioned(spark, name):
    """No window over facts runs in a single task: each names its partition columns.

    The bands of a single group may be ordered in one task: their number is bounded by the value range.
    """
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for spec in re.findall(r"windowspecdefinition\(([^()]*)", plan):
        assert spec.startswith("band#") or not re.match(r"[\w#]+ (ASC|DESC)", spec.strip()), spec


def test_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    """A task's share of a shuffle stays the same however large the tables are; settings that are tighter already stay."""
    from tidemark import session

    (tmp_path / "t.parquet").write_bytes(b"x" * 1000)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = [spark.conf.get(n) for n in names]
    try:
        monkeypatch.setattr(session, "INPUT_BYTES", 10)
        for size, count, joined in (("64MB", "100", session.TASK_BYTES), ("1m", "100", 1 << 20), ("8192k", "100", session.TASK_BYTES)):
            spark.conf.set(names[0], "4")
            spark.conf.set(names[1], size)
            session.sized(spark, str(tmp_path / "t.parquet"))
            assert spark.conf.get(names[0]) == count and session._bytes(spark.conf.get(names[1])) == joined
        spark.conf.set(names[0], "300")
        session.sized(spark, str(tmp_path / "t.parquet"))
        assert spark.conf.get(names[0]) == "300"
    finally:
        for n, x in zip(names, before):
            spark.conf.set(n, x)


def test_scans_are_cut_small(spark, tmp_path):
    """A task that reads order lines sorts what it read for the shuffle, so the size of a split is limited too."""
    from tidemark import session

    (tmp_path / "t.parquet").write_bytes(b"x" * 1000)
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for size, kept in (("128MB", session.SCAN_BYTES), ("16m", 16 << 20)):
            spark.conf.set(name, size)
            session.sized(spark, str(tmp_path / "t.parquet"))
            assert session._bytes(spark.conf.get(name)) == kept
        spark.conf.set(name, "128MB")
        QUERIES["purchase_gaps"](spark, SF)
        assert session._bytes(spark.conf.get(name)) == session.SCAN_BYTES
    finally:
        spark.conf.set(name, before)


def test_lines_are_shuffled_as_numbers(spark, tmp_path):
    """The flag of a line is read before the join: only numbers are shuffled and sorted, and quantities and prices stay as they were."""
    from tidemark.sources.adapters import SCHEMAS, order_lines, read_table

    orders = [(1, 10, "O", 1.0, "1-URGENT"), (2, 11, "O", 1.0, "2-HIGH")]
    lines = [(1, 5.0, 10.0, "R"), (1, 4.0, 10.0, "N"), (1, 3.0, 0.0, "R"), (2, 3.0, None, "R"), (2, None, 7.0, "A"), (2, 2.0, 7.0, None), (None, 2.0, 7.0, "R"), (3, 0.0, 7.0, "R")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").selectExpr(
        "*", "timestamp_ntz'1998-01-02' as o_orderdate"
    ).write.parquet(str(tmp_path / "orders.parquet"))
    given = spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_extendedprice double, l_returnflag string")
    names = [x.split()[0] for x in SCHEMAS["lineitem"].split(", ")]
    kinds = dict(x.split() for x in SCHEMAS["lineitem"].split(", "))
    given.selectExpr(*[c if c in given.columns else f"cast(null as {kinds[c]}) as {c}" for c in names]).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert read_table(spark, str(tmp_path), "lineitem").count() == len(lines)

    df = order_lines(spark, str(tmp_path))
    got = sorted(((r.Invoice, r.Quantity, r.Price) for r in df.collect()), key=str)
    assert got == sorted([(1, -5.0, 2.0), (1, 4.0, 2.5), (1, -3.0, 0.0), (2, -3.0, None), (2, None, None), (2, 2.0, 3.5)], key=str)
    below = df._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")[1]
    projects = [x for x in below.splitlines() if "Project [" in x]
    assert projects and not any(re.search(r"[\[,] ?l_returnflag#\d+[,\]]", x) for x in projects)
