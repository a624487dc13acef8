"""Customer features of many snapshots in one pass.

The lines are reduced before anything is multiplied by snapshots or ordered:

* a *basket* is one (customer, invoice, time, side of the ledger); its lines combine on the map side;
* a *cell* is one (customer, half day). Windows start at midnight and their midpoints fall on a half
  day, so a cell lies wholly inside or outside any window half, and purchases within one cell are less
  than a day apart. A customer has at most two cells per calendar day, so ordering the cells of even
  the busiest customer is bounded by the calendar and not by the volume of lines.

Snapshots are attached by an equi-join on the day with a broadcast day table (at most
ceil(window / step) rows per calendar day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.numeric import finite, money_units
from tidemark.functions.temporal import day_of, elapsed_days, half_of_day
from tidemark.operators.ordering import quantiles
from tidemark.params import FEATURES, INTERVAL_POINTS, LABEL


def window_days(calendar: DataFrame, outcome: bool = True) -> DataFrame:
    """Each day of each feature (and outcome) window: ``day, snapshot_no, role`` and the boundaries."""
    cols = ["snapshot_no", "feature_start", "midpoint", "feature_end"]

    def days(role: str, start: str, end: str) -> DataFrame:
        span = F.sequence(day_of(F.col(start)), F.date_sub(day_of(F.col(end)), 1))
        return calendar.where(F.col(start) < F.col(end)).select(
            F.explode(span).alias("day"), *cols, F.lit(role).alias("role")
        )

    feature = days("feature", "feature_start", "feature_end")
    if not outcome:
        return feature
    return feature.unionByName(days("outcome", "outcome_start", "outcome_end"))


def snapshot_membership(tx: DataFrame, calendar: DataFrame, outcome: bool = True) -> DataFrame:
    """Lines with the snapshot and role of every window that contains them."""
    days = F.broadcast(window_days(calendar, outcome))
    return tx.withColumn("day", day_of(F.col("InvoiceDate"))).join(days, "day").drop("day")


def feature_outcome_split(tx: DataFrame, calendar: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The feature lines and the outcome lines of every snapshot."""
    rows = snapshot_membership(tx, calendar).drop("feature_start", "midpoint", "feature_end")
    return tuple(rows.where(F.col("role") == r).drop("role") for r in ("feature", "outcome"))


def baskets(tx: DataFrame) -> DataFrame:
    """One row per customer, invoice, time and side of the ledger.

    ``items`` is positive for a sale, negative for a return and zero when the line only shows presence.
    The filter states what every window join needs, so all branches read one and the same shuffle.
    """
    qty = F.col("Quantity")
    return (
        tx.where(day_of(F.col("InvoiceDate")).isNotNull())
        .groupBy("CustomerID", "Invoice", "InvoiceDate", F.signum(qty).alias("side"))
        .agg(
            F.sum(money_units(finite(F.col("Price") * F.abs(qty)))).alias("units"),
            F.sum(qty).alias("items"),
        )
    )




SALE = "items > 0"
RETURN = "items < 0"


def first_sales(earlier: DataFrame) -> DataFrame:
    """History before the first window, as cells: all that matters of it is each customer's first sale."""
    first = earlier.where(F.col("Quantity") > 0).groupBy("CustomerID").agg(F.min("InvoiceDate").alias("sale_first"))
    return first.select(
        "CustomerID",
        day_of(F.col("sale_first")).alias("day"),
        half_of_day(F.col("sale_first")).alias("half"),
        "sale_first",
        F.col("sale_first").alias("sale_last"),
    )


def cells(basket: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """One row per customer and half day, knowing the customer's previous sale and return.

    ``<side>_pairs`` counts distinct (invoice, time) pairs; ``prev_<side>`` is the last time before
    this cell; ``first_sale`` is the first sale up to and including this cell, or among the ``earlier``
    lines.
    """
    aggs = [f"sum(case when {SALE} then units end) as recent_units"]
    for side, hit in (("sale", SALE), ("return", RETURN)):
        aggs += [
            f"sum(case when {hit} then items end) as {side}_items",
            f"count_if({hit}) as {side}_pairs",
            f"min(case when {hit} then InvoiceDate end) as {side}_first",
            f"max(case when {hit} then InvoiceDate end) as {side}_last",
        ]
    ts = F.col("InvoiceDate")
    cell = basket.groupBy("CustomerID", day_of(ts).alias("day"), half_of_day(ts).alias("half")).agg(*map(F.expr, aggs))
    if earlier is not None:
        cell = cell.unionByName(first_sales(earlier), allowMissingColumns=True)
    order = Window.partitionBy("CustomerID").orderBy("day", "half")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        cell.withColumn("prev_sale", F.last("sale_last", ignorenulls=True).over(before))
        .withColumn("prev_return", F.last("return_last", ignorenulls=True).over(before))
        .withColumn("first_sale", F.min("sale_first").over(upto))
    )


def _cell_measures(cell: DataFrame, days: DataFrame) -> DataFrame:
    """Cells in windows, reduced to the measures that add up per (snapshot, customer)."""
    feature = "role = 'feature'"
    at = "(cast(day as timestamp_ntz) + make_dt_interval(0, half * 12))"

    def gap(side: str) -> str:
        """Elapsed days since the previous purchase, if that lies in the window too."""
        days_between = f"extract(DAY from {side}_first - prev_{side})"
        return f"case when {feature} and prev_{side} >= feature_start then {days_between} end as {side}_gap"

    plain = ("feature_end", "sale_items", "sale_pairs", "return_items", "return_pairs", "first_sale")
    return cell.join(F.broadcast(days), "day").selectExpr(
        "snapshot_no",
        "CustomerID",
        *[f"case when {feature} then {c} end as {c}" for c in plain],
        f"case when {feature} and {at} >= midpoint then recent_units end as recent_units",
        gap("sale"),
        gap("return"),
        f"case when {feature} and sale_last is not null then day end as last_sale_day",
        "role = 'outcome' and sale_last is not null as bought_later",
    )


def _invoice_measures(basket: DataFrame, days: DataFrame) -> DataFrame:
    """Amounts and distinct invoices: one row per (snapshot, customer, invoice) says what it adds."""
    rows = basket.withColumn("day", day_of(F.col("InvoiceDate")))
    rows = rows.join(F.broadcast(days.where(F.col("role") == "feature")), "day")
    counted = lambda hit: f"cast(max({hit} and Invoice is not null) as bigint)"
    aggs = (
        f"sum(case when {SALE} then units end) as sale_units",
        f"sum(case when {RETURN} then units end) as return_units",
        f"{counted(SALE)} as sale_txs",
        f"{counted(RETURN)} as return_txs",
        f"{counted(SALE + ' and InvoiceDate >= midpoint')} as recent_txs",
        f"{counted(SALE + ' and InvoiceDate < midpoint')} as early_txs",
    )
    return rows.groupBy("snapshot_no", "CustomerID", "Invoice").agg(*map(F.expr, aggs)).drop("Invoice")


def _measures(tx: DataFrame, calendar: DataFrame, outcome: bool, earlier: DataFrame | None = None) -> DataFrame:
    """All measures per (snapshot, customer): both branches share the basket shuffle, one final shuffle."""
    basket = baskets(tx)
    days = window_days(calendar, outcome)
    both = _cell_measures(cells(basket, earlier), days).unionByName(
        _invoice_measures(basket, days), allowMissingColumns=True
    )
    sums = (
        "sale_units", "sale_items", "sale_pairs", "sale_gap", "return_units", "return_items", "return_pairs",
        "return_gap", "recent_units", "sale_txs", "return_txs", "recent_txs", "early_txs",
    )
    aggs = (
        *[f"coalesce(sum({c}), 0L) as {c}" for c in sums],
        "max(feature_end) as feature_end",
        "max(last_sale_day) as last_sale_day",
        "min(first_sale) as first_sale",
        "coalesce(max(bought_later), false) as bought_later",
    )
    # Without a feature end the customer came only in the outcome window and is not in the cohort.
    return both.groupBy("snapshot_no", "CustomerID").agg(*map(F.expr, aggs)).where("feature_end is not null")


def _money(units: str) -> str:
    return f"cast({units} as double)"


def _mean_gap(side: str) -> str:
    return f"case when {side}_pairs > 1 then cast({side}_gap as double) / ({side}_pairs - 1) end"


COLUMNS = {
    "total_sales_revenue": _money("sale_units"),
    "total_items_purchased": "abs(sale_items)",
    "total_sale_txs": "sale_txs",
    "avg_sale_days": _mean_gap("sale"),
    "recency": "datediff(cast(feature_end as date), last_sale_day)",
    "total_return_amount": _money("return_units"),
    "total_items_returned": "abs(return_items)",
    "total_return_txs": "return_txs",
    "avg_return_days": f"coalesce({_mean_gap('return')}, 0D)",
    "tenure_days": "case when first_sale < feature_end then extract(DAY from feature_end - first_sale) end",
    "recent_revenue": _money("recent_units"),
    # Recent minus early, where early is the rest of the window.
    "revenue_momentum": "case when sale_units > 0 then 2 * cast(recent_units as double) / cast(sale_units as double) - 1 else 0D end",
    "recent_tx_count": "recent_txs",
    "tx_count_momentum": "case when recent_txs + early_txs > 0 then cast(recent_txs - early_txs as double) / (recent_txs + early_txs) else 0D end",
}


def _as_rows(m: DataFrame, names, label: bool = False) -> DataFrame:
    cols = [f"cast({COLUMNS[n]} as double) as {n}" for n in names]
    if label:
        cols.append(f"cast(not bought_later as int) as {LABEL}")
    return m.selectExpr("snapshot_no", "CustomerID", "cast(feature_end as date) as snapshot_date", *cols)


def customer_features(tx: DataFrame, calendar: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """All features of every customer with any line in the feature window, per snapshot.

    ``tx`` holds the whole history, or the lines from the first window on, with the lines before it as
    ``earlier``: those then cost one small aggregation instead of the full reduction.
    """
    return _as_rows(_measures(tx, calendar, False, earlier), FEATURES)


def training_dataset(tx: DataFrame, calendar: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Features and the inactivity label: 1 when the outcome window holds no sale."""
    return _as_rows(_measures(tx, calendar, True, earlier), FEATURES, label=True)


def scoring_dataset(tx: DataFrame, calendar: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Features per ``as_of`` date. Lines at or after the newest cutoff never enter."""
    return customer_features(tx, calendar, earlier).drop("snapshot_no")


def rfm_features(tx: DataFrame, calendar: DataFrame) -> DataFrame:
    names = (
        "total_sales_revenue", "total_items_purchased", "total_sale_txs", "recency",
        "total_return_amount", "total_items_returned", "total_return_txs",
    )
    return _as_rows(_measures(tx, calendar, outcome=False), names)


def momentum_features(tx: DataFrame, calendar: DataFrame) -> DataFrame:
    """Recent halves and momenta of the customers who bought in the window."""
    m = _measures(tx, calendar, outcome=False).where(F.col("sale_pairs") > 0)
    return _as_rows(m, ("recent_revenue", "revenue_momentum", "recent_tx_count", "tx_count_momentum"))


def purchase_gaps(tx: DataFrame, calendar: DataFrame) -> DataFrame:
    """Mean whole days between consecutive purchases and returns in the feature window."""
    return _as_rows(_measures(tx, calendar, outcome=False), ("avg_sale_days", "avg_return_days"))


def tenure_days(tx: DataFrame, calendar: DataFrame) -> DataFrame:
    """Whole days since the first sale of the whole history before the cutoff."""
    return _as_rows(_measures(tx, calendar, outcome=False), ("tenure_days",))


def purchase_intervals(tx: DataFrame) -> DataFrame:
    """Whole-history mean gap per buying customer, NULL with a single purchase."""
    cell = cells(baskets(tx.where(F.col("Quantity") > 0)))
    gap = elapsed_days(F.col("prev_sale"), F.col("sale_first"))
    return cell.groupBy("CustomerID").agg(
        (F.coalesce(F.sum(gap), F.lit(0)).cast("double") / F.nullif(F.sum("sale_pairs") - 1, F.lit(0))).alias(
            "avg_days_between_purchases"
        )
    )


def interval_summary(tx: DataFrame) -> DataFrame:
    """One row: percentiles of the customers' mean gaps, the median in months of 30 days, and how many
    customers bought at all and more than once."""
    per = purchase_intervals(tx).withColumn("scope", F.lit("all"))
    q = quantiles(per, ["scope"], "avg_days_between_purchases", INTERVAL_POINTS).select("q", "n")
    buyers = per.agg(F.count("*").alias("buyers"))
    both = q.unionByName(buyers, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("q", "n", "buyers")])
    return both.select(
        *[F.col("q")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(INTERVAL_POINTS)],
        (F.col("q")[INTERVAL_POINTS.index(0.50)] / 30).alias("median_months"),
        F.coalesce("n", F.lit(0)).alias("repeat_buyers"),
        "buyers",
    )
