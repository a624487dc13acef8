"""Inputs of the registered queries, all derived from the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.functions.temporal import day_of, month_start
from tidemark.operators import calendar as cal
from tidemark.operators import labels as lab
from tidemark.operators.delayed import resolved_predictions
from tidemark.operators.features import window_days
from tidemark.operators.quality import monthly_volume
from tidemark.operators.scoring import score_projection
from tidemark.params import LABEL
from tidemark.sources.adapters import EVENT_PLAN, ORDER_PLAN, order_lines, read_table

ROUND = 6


def portable(df: DataFrame) -> DataFrame:
    """Plain output types: dates and times as text, whole numbers as bigint, doubles to six places."""
    out = []
    for f in df.schema:
        c, t = F.col(f"`{f.name}`"), f.dataType.typeName()
        if t == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif t in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif t in ("integer", "short", "byte"):
            c = c.cast("bigint")
        elif t in ("double", "float"):
            # Scaled, rounded half to even and scaled back: the same three IEEE operations as in the SQL.
            # + 0.0 turns a negative zero into zero.
            c = F.rint(c.cast("double") * F.lit(10.0**ROUND)) / F.lit(10.0**ROUND) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


def order_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """The last order date, read once: a declared data-through boundary."""
    end = read_table(spark, sf, "orders").agg(F.max("o_orderdate")).first()[0]
    return cal.known_coverage(spark, end)


def event_coverage(spark: SparkSession, sf: str) -> DataFrame:
    end = read_table(spark, sf, "events").agg(F.max("ts")).first()[0]
    return cal.known_coverage(spark, end)


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return cal.labelled_calendar(order_coverage(spark, sf), ORDER_PLAN)


def scorable(spark: SparkSession, sf: str) -> DataFrame:
    return cal.scorable_calendar(order_coverage(spark, sf), ORDER_PLAN)


def event_labelled(spark: SparkSession, sf: str) -> DataFrame:
    return cal.labelled_calendar(event_coverage(spark, sf), EVENT_PLAN)


def raw_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as an uncleaned feed: orders of unspecified priority lack the customer, and returned
    lines are delivered twice."""
    tx = order_lines(spark, sf, "o_orderpriority")
    tx = tx.withColumn(
        "CustomerID", F.when(~F.col("o_orderpriority").startswith("4"), F.col("CustomerID"))
    ).select("Invoice", "StockCode", "Quantity", "InvoiceDate", "Price", "CustomerID")
    copies = F.when(F.col("Quantity") < 0, 2).otherwise(1)
    return tx.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")


def month_starts(spark: SparkSession, sf: str) -> DataFrame:
    """First days of the months with orders, as ``as_of``."""
    return (
        read_table(spark, sf, "orders").select(month_start(F.col("o_orderdate")).alias("as_of")).distinct()
    )


def cohort_scores(tx: DataFrame, calendar: DataFrame, outcome: bool = False) -> DataFrame:
    """Every customer present in a feature window with the fixture score recency / (recency + 30).

    A score without a model, so that every metric of it can be checked exactly; 0.5 without a sale.
    """
    days = window_days(calendar, outcome).select("day", "snapshot_no", "role", "feature_end")
    # Customers' days first: they meet the windows once, not once per line.
    rows = tx.groupBy("CustomerID", day_of(F.col("InvoiceDate")).alias("day")).agg(F.max(F.col("Quantity") > 0).alias("sale"))
    inside = F.col("role") == "feature"
    recency = F.datediff(day_of(F.col("feature_end")), F.col("last_sale")).cast("double")
    return (
        rows.join(F.broadcast(days), "day")
        .groupBy("snapshot_no", "CustomerID", "feature_end")
        .agg(
            F.max(F.when(inside & F.col("sale"), F.col("day"))).alias("last_sale"),
            F.max(inside).alias("present"),
            F.max(~inside & F.col("sale")).alias("bought_later"),
        )
        .where("present")
        .select(
            "snapshot_no",
            "CustomerID",
            day_of(F.col("feature_end")).alias("snapshot_date"),
            F.coalesce(recency / (recency + F.lit(30.0)), F.lit(0.5)).alias("churn_probability"),
            recency.alias("recency"),
            (~F.col("bought_later")).cast("int").alias(LABEL),
        )
    )


def with_roles(base: DataFrame, *extra: str) -> DataFrame:
    """Prediction rows of an official (v2) and a shadow (v1) score, the latter with a horizon of 60."""
    roles = F.array(
        F.struct(F.lit("official").alias("role"), F.lit("v2").alias("version"), F.lit(30.0).alias("h"), F.lit(0.5).alias("t")),
        F.struct(F.lit("shadow").alias("role"), F.lit("v1").alias("version"), F.lit(60.0).alias("h"), F.lit(0.4).alias("t")),
    )
    both = base.withColumn("r", F.explode(roles)).withColumn(
        "churn_probability", F.coalesce(F.col("recency") / (F.col("recency") + F.col("r.h")), F.lit(0.5))
    )
    return score_projection(
        both.select("*", "r.*"),
        F.col("t"),
        model_type="fixture",
        model_version=F.col("version"),
        role=F.col("role"),
        run_id="run-1",
        scored_at="2002-01-01T00:00:00Z",
        plan=ORDER_PLAN,
        extra=extra,
    )


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Both roles' prediction rows of every scorable snapshot, from one pass."""
    return with_roles(cohort_scores(order_lines(spark, sf), scorable(spark, sf)))


def matured_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of the snapshots whose outcome window is covered."""
    return predictions(spark, sf).join(F.broadcast(labelled_dates(spark, sf)), "snapshot_date", "left_semi")


def labelled_dates(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select(day_of(F.col("feature_end")).alias("snapshot_date"))


def labelled_windows(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select(day_of(F.col("feature_end")).alias("snapshot_date"), "outcome_start", "outcome_end")


def resolved(spark: SparkSession, sf: str) -> DataFrame:
    """Matured predictions joined one to one with their outcome labels."""
    mature = matured_predictions(spark, sf)
    cohort = mature.where(F.col("prediction_role") == "official")
    outcome = lab.outcome_labels(cohort, order_lines(spark, sf), ORDER_PLAN, labelled_windows(spark, sf))
    return resolved_predictions(mature, outcome)


def evaluated(spark: SparkSession, sf: str) -> DataFrame:
    """Matured predictions with their outcome from one pass over the lines: the input of the metrics.

    Equal to :func:`resolved`, which goes through stored labels and a join.
    """
    return with_roles(cohort_scores(order_lines(spark, sf), labelled(spark, sf), outcome=True), LABEL)


def month_files(spark: SparkSession, sf: str) -> DataFrame:
    """One delivered file per order month: name, content hash, snapshot date, row count."""
    month = monthly_volume(order_lines(spark, sf))
    content = F.concat_ws("|", F.date_format("month", "yyyy-MM-dd"), F.col("tx_count").cast("string"), F.col("customer_count").cast("string"))
    return month.select(
        F.concat(F.lit("tx_"), F.date_format("month", "yyyy-MM"), F.lit(".csv")).alias("source_file"),
        F.sha2(content, 256).alias("sha256"),
        F.date_format(F.add_months("month", 1), "yyyy-MM-dd").alias("snapshot_date"),
        F.col("tx_count").alias("raw_rows"),
    )


def month_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Load records of the files: every June file failed, and the last two months are still to come."""
    files = month_files(spark, sf)
    end = order_coverage(spark, sf).select(F.date_format(F.add_months(month_start(F.col("coverage_end")), -1), "yyyy-MM-dd").alias("e"))
    last = F.lit(end.first().e)
    status = F.when(F.substring("snapshot_date", 6, 2) == "07", "FAILED").otherwise("SUCCESS")
    return files.where(F.col("snapshot_date") <= last).select(
        "*", status.alias("status"), F.concat("snapshot_date", F.lit("T01:00:00Z")).alias("recorded_at")
    )


def promotions(spark: SparkSession, sf: str) -> DataFrame:
    """A promotion in every month that had more orders than the month before."""
    m = monthly_volume(order_lines(spark, sf))
    grew = F.col("tx_count") > F.lag("tx_count").over(Window.partitionBy(F.lit(1)).orderBy("month"))
    return m.withColumn("grew", grew).where("grew").select(
        F.lit("gbt").alias("model_type"),
        F.concat(F.lit("v"), F.date_format("month", "yyyyMM")).alias("version"),
        F.col("month").alias("promoted_at"),
    )
