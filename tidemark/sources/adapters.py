"""Views that give stored order and event tables the transaction schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.params import SnapshotPlan
from tidemark.session import sized

ORDER_PLAN = SnapshotPlan(start=date(1995, 1, 1))
EVENT_PLAN = SnapshotPlan(start=date(2024, 1, 1), feature=10, outcome=5, step=5, unit="day")


# Declared so that no job has to open file footers to find the columns.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Order lines as transactions, with further columns of the order; a returned line has a negative quantity."""
    sized(spark, *(f"{sf_dir}/{name}.parquet" for name in ("orders", "lineitem")))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", *extra)
    # The sign goes into both numbers before the join, so that a line is shuffled and sorted as three numbers.
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        (sign * F.col("l_quantity")).alias("quantity"),
        (sign * F.col("l_extendedprice")).alias("amount"),
    )
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("Invoice"),
        F.col("l_partkey").alias("StockCode"),
        F.col("quantity").alias("Quantity"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("InvoiceDate"),
        (F.col("amount") / F.col("quantity")).alias("Price"),
        F.col("o_custkey").alias("CustomerID"),
        *extra,
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transactions: a purchase sells one, an error returns one, the rest only shows presence."""
    kind = F.col("event_type")
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Invoice"),
        kind.alias("StockCode"),
        F.when(kind == "purchase", 1.0).when(kind == "error", -1.0).otherwise(0.0).alias("Quantity"),
        F.col("ts").cast("timestamp_ntz").alias("InvoiceDate"),
        F.col("value").alias("Price"),
        F.col("user_id").alias("CustomerID"),
    )
