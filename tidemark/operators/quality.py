"""Structural and volume checks. Each check is a row or a column of counts, never a driver-side loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import finite, money, money_units
from tidemark.functions.temporal import midnight, month_start, shift
from tidemark.params import QualityPolicy
from tidemark.sources.transactions import REQUIRED, parsed_time


def missing_columns(df: DataFrame) -> list[str]:
    return sorted(set(REQUIRED) - set(df.columns))


def structural_quality(df: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """One row per check: ``check_name, observed, limit_value, passed``.

    A missing column ends the checks, since nothing else can be judged.
    """
    missing = missing_columns(df)
    spark = df.sparkSession
    if missing:
        return spark.range(0, 1, 1, 1).select(
            F.lit("missing_columns").alias("check_name"),
            F.lit(float(len(missing))).alias("observed"),
            F.lit(0.0).alias("limit_value"),
            F.lit(False).alias("passed"),
        )
    text = lambda c: F.col(c).cast("string")
    bad_number = lambda c: F.count_if(F.col(c).isNotNull() & text(c).try_cast("double").isNull())
    # Copies collapse before the shuffle; NULLs compare equal, as they do for row duplicates.
    # A feed as text may hold times that do not parse; any other type than text and time is no time at all.
    kind = df.schema["InvoiceDate"].dataType.typeName()
    bad_time = F.count_if(F.col("InvoiceDate").isNotNull() & parsed_time().isNull()) if kind == "string" else F.lit(0)
    if kind not in ("string", "timestamp", "timestamp_ntz"):
        bad_time = F.count("*")
    lines = df.groupBy("Invoice", "StockCode", "Quantity", "InvoiceDate").agg(
        F.count("*").alias("rows"),
        bad_time.cast("long").alias("bad_time"),
        F.count_if(F.col("CustomerID").isNull()).alias("no_customer"),
        bad_number("Quantity").alias("bad_quantity"),
        bad_number("Price").alias("bad_price"),
    )
    t = lines.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_lines"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("no_customer", "bad_time", "bad_quantity", "bad_price")],
    )
    rows = F.col("rows")
    share = lambda c: F.when(rows > 0, c.cast("double") / rows).otherwise(0.0)
    found = [
        ("empty_file", F.when(rows == 0, 1.0).otherwise(0.0), 0.0),
        ("date_not_parsed", F.col("bad_time").cast("double"), 0.0),
        ("quantity_not_numeric", F.col("bad_quantity").cast("double"), 0.0),
        ("price_not_numeric", F.col("bad_price").cast("double"), 0.0),
        ("null_customer_fraction", share(F.col("no_customer")), policy.max_null_customer),
        ("duplicate_line_rate", share(rows - F.col("distinct_lines")), policy.max_duplicate_rate),
    ]
    checks = F.array(
        *[F.struct(F.lit(n).alias("check_name"), v.alias("observed"), F.lit(float(m)).alias("limit_value")) for n, v, m in found]
    )
    return t.select(F.inline(checks)).withColumn("passed", F.col("observed") <= F.col("limit_value"))


def require_quality(checks: DataFrame) -> None:
    """Raise with the failed checks. The check table has a handful of rows."""
    failed = [r.asDict() for r in checks.where(~F.col("passed")).collect()]
    if failed:
        raise ValueError(f"structural validation failed: {failed}")


def batch_bounds_violations(df: DataFrame, snapshot_date: Column) -> DataFrame:
    """One row: lines outside the calendar month before ``snapshot_date``, and all lines."""
    end = midnight(snapshot_date)
    d = F.col("InvoiceDate")
    outside = (d < shift(end, -1, "month")) | (d >= end)
    return df.agg(F.count_if(outside).alias("violations"), F.count("*").alias("rows"))


def require_batch_month(df: DataFrame, snapshot_date: str) -> None:
    n = batch_bounds_violations(df, F.lit(snapshot_date).cast("date")).first().violations
    if n:
        raise ValueError(f"{n} rows lie outside the month before {snapshot_date}")


def monthly_volume(tx: DataFrame) -> DataFrame:
    """Distinct invoices, distinct customers and signed revenue per calendar month.

    The two distinct counts are nested groupings over one reduced table, so no row is multiplied and
    a busy month spreads over its invoices and customers.
    """
    amount = money_units(finite(F.col("Price") * F.col("Quantity")))
    reduced = (
        tx.where(F.col("InvoiceDate").isNotNull())
        .groupBy(month_start(F.col("InvoiceDate")).alias("month"), "Invoice", "CustomerID")
        .agg(F.sum(amount).alias("units"))
    )
    invoices = reduced.groupBy("month", "Invoice").agg(F.sum("units").alias("units"))
    customers = reduced.groupBy("month", "CustomerID").agg(F.sum("units").alias("units"))
    parts = invoices.select(
        "month", F.col("Invoice").isNotNull().cast("int").alias("tx"), F.lit(0).alias("customer"), "units"
    ).unionByName(
        customers.select(
            "month", F.lit(0).alias("tx"), F.col("CustomerID").isNotNull().cast("int").alias("customer"),
            F.lit(None).cast(customers.schema["units"].dataType).alias("units"),
        )
    )
    return parts.groupBy("month").agg(
        F.sum("tx").alias("tx_count"),
        F.sum("customer").alias("customer_count"),
        money(F.coalesce(F.sum("units"), F.lit(0))).alias("revenue"),
    )


def _long_volume(monthly: DataFrame) -> DataFrame:
    wide = monthly.select("month", *[F.col(c).cast("double").alias(c) for c in ("tx_count", "customer_count", "revenue")])
    return wide.unpivot(["month"], ["tx_count", "customer_count", "revenue"], "metric", "value")


def monthly_baseline(monthly: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Mean and population standard deviation per metric over the last observed months.

    ``monthly`` has one row per month, so ranking the months is a matter of a few rows.
    """
    newest = Window.partitionBy("metric").orderBy(F.desc("month"))
    return (
        _long_volume(monthly)
        .withColumn("age", F.row_number().over(newest))
        .where(F.col("age") <= policy.trailing_months)
        .groupBy("metric")
        .agg(F.avg("value").alias("mean"), F.nullif(F.stddev_pop("value"), F.lit(0.0)).alias("std"))
    )


def _severity(z: Column, policy: QualityPolicy) -> Column:
    return (
        F.when(z.isNull(), "SKIPPED")
        .when(F.abs(z) > policy.hard_z, "ERROR")
        .when(F.abs(z) > policy.soft_z, "WARNING")
        .otherwise("OK")
    )


def volume_check(batch: DataFrame, baseline: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Each metric of a whole batch against a stored baseline. Both sides have three rows."""
    whole = monthly_volume(batch.withColumn("InvoiceDate", F.lit("2000-01-01").cast("timestamp_ntz")))
    z = (F.col("value") - F.col("mean")) / F.col("std")
    return (
        _long_volume(whole)
        .drop("month")
        .join(F.broadcast(baseline), "metric")
        .select("metric", "value", "mean", "std", z.alias("z_score"))
        .withColumn("status", _severity(F.col("z_score"), policy))
    )


def volume_anomalies(monthly: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Every month scored against the observed months before it (at most ``trailing_months``)."""
    trail = Window.partitionBy("metric").orderBy("month").rowsBetween(-policy.trailing_months, -1)
    z = (F.col("value") - F.col("mean")) / F.col("std")
    return (
        _long_volume(monthly)
        .withColumn("mean", F.avg("value").over(trail))
        .withColumn("std", F.nullif(F.stddev_pop("value").over(trail), F.lit(0.0)))
        .withColumn("z_score", z)
        .withColumn("status", _severity(F.col("z_score"), policy))
    )


def prediction_quality(predictions: DataFrame, cohort: str = "snapshot_date") -> DataFrame:
    """Violation counts per cohort: missing ids, surplus rows per id, bad probabilities, bad classes."""
    p, c = F.col("churn_probability").cast("double"), F.col("predicted_churn")
    bad_p = p.isNull() | F.isnan(p) | (p < 0) | (p > 1)
    per_id = predictions.groupBy(cohort, "CustomerID").agg(
        F.count("*").alias("rows"),
        F.count_if(bad_p).alias("bad_p"),
        F.count_if(c.isNull() | ~c.isin(0, 1)).alias("bad_c"),
    )
    no_id = F.col("CustomerID").isNull()
    return (
        per_id.groupBy(cohort)
        .agg(
            F.sum("rows").alias("rows"),
            F.coalesce(F.sum(F.when(no_id, F.col("rows"))), F.lit(0)).alias("null_ids"),
            F.coalesce(F.sum(F.when(~no_id, F.col("rows") - 1)), F.lit(0)).alias("duplicate_ids"),
            F.sum("bad_p").alias("probability_out_of_range"),
            F.sum("bad_c").alias("class_out_of_range"),
        )
        .withColumn(
            "passed",
            (F.col("null_ids") + F.col("duplicate_ids") + F.col("probability_out_of_range") + F.col("class_out_of_range")) == 0,
        )
    )
