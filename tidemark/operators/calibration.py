"""Equal-count calibration tables and the expected calibration error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.ordering import running_totals, text_ranks
from tidemark.session import written


def cut_points(bins: int) -> list[float]:
    """Inner quantile points as percentages taken back to fractions: the double values that decide on
    which side of an edge a rank falls when the edge is a whole number."""
    return [i * (1.0 / bins) * 100.0 / 100.0 for i in range(1, bins)]


def _edges(n: Column, bins: int) -> Column:
    """Inner edges between the ranks 1..n, interpolated from the nearer rank."""

    def edge(point: Column) -> Column:
        pos = point * (n - 1)
        lo = F.floor(pos)
        t = pos - lo
        return F.when(t < 0.5, lo + 1 + t).otherwise(lo + 2 - (1 - t))

    points = F.array(*[F.lit(p) for p in cut_points(bins)]).cast("array<double>")
    return F.transform(points, edge)


def _bin_of(rank: Column, n: Column, edges: Column, bins: int) -> Column:
    """Bin of a 1-based rank among ``n`` when the ranks are cut at equal quantiles, right-closed.

    Only the inner edge nearest to the rank can be in doubt; all lower ones lie below it. With fewer
    ranks than bins every rank is a bin of its own.
    """
    nearest = F.rint((rank - 1) * bins / F.greatest(n - 1, F.lit(1))).cast("int")
    above = F.greatest(nearest, F.lit(1)) + F.coalesce((rank > F.get(edges, nearest - 1)).cast("int"), F.lit(0))
    return F.when(n < bins, rank).otherwise(F.least(above, F.lit(bins))).cast("int")


def calibration_deciles(
    rows: DataFrame,
    cohort: Sequence[str],
    outcome: str,
    probability: str = "churn_probability",
    bins: int = 10,
    customer: str = "CustomerID",
) -> DataFrame:
    """Calibration per cohort and bin, customers ranked by probability and then id.

    Customers with one probability form a block that spans a range of ranks. A block inside one bin is added whole.
    Only the blocks that cross a bin edge (at most bins - 1 per cohort) go back to their rows, which are ranked by
    id in bands and cells of ids (numbers) or by the characters in which ids differ (texts), so no task orders a whole
    block, however ids are spread and however many customers share a probability. Ids are unique in their cohort.
    """
    g = list(cohort)
    scored = written(
        rows.select(*g, F.col(customer).alias("id"), F.col(probability).cast("double").alias("p"), F.col(outcome).cast("int").alias("y")), "calibration"
    )
    scored = scored.withColumn("rows", F.lit(1))
    r = running_totals(scored, g, ["p"], ["rows", "y"]).withColumn("n_all", F.col("rows_total"))
    # The edges depend on the size of the cohort alone.
    r = r.withColumn("edges", _edges(F.col("n_all"), bins))
    where = lambda rank: _bin_of(rank, F.col("n_all"), F.col("edges"), bins)
    r = r.select(
        *g,
        "p",
        "rows",
        "y",
        "rows_below",
        "n_all",
        "edges",
        where(F.col("rows_below") + 1).alias("first_bin"),
        where(F.col("rows_below") + F.col("rows")).alias("last_bin"),
    )
    inside = r.where(F.col("first_bin") == F.col("last_bin")).select(
        *g, F.col("first_bin").alias("risk_decile"), F.col("rows").alias("n"), (F.col("p") * F.col("rows")).alias("sum_p"), F.col("y").alias("pos")
    )
    # At most bins - 1 blocks per cohort, and cohorts follow the calendar.
    crossing = F.broadcast(r.where(F.col("first_bin") < F.col("last_bin")).select(*g, "p", F.col("rows_below").alias("block_below"), "n_all", "edges"))
    tied = scored.join(crossing.select(*g, "p"), [*g, "p"], "left_semi")
    if rows.schema[customer].dataType.typeName() == "string":
        placed = text_ranks(tied, [*g, "p"], "id")
    else:
        placed = running_totals(tied.withColumn("place", F.col("id").cast("double")), [*g, "p"], ["place", "id"], ["rows", "y"])
    split = (
        placed.join(crossing, [*g, "p"])
        .withColumn("rank", F.col("block_below") + F.col("rows_below") + 1)
        .groupBy(*g, where(F.col("rank")).alias("risk_decile"))
        .agg(F.count("*").alias("n"), F.sum("p").alias("sum_p"), F.sum("y").alias("pos"))
    )
    mean_p, rate = F.col("sum_p") / F.col("n"), F.col("pos") / F.col("n")
    return (
        inside.unionByName(split)
        .groupBy(*g, "risk_decile")
        .agg(*[F.sum(c).alias(c) for c in ("n", "sum_p", "pos")])
        .select(
            *g,
            "risk_decile",
            "n",
            mean_p.alias("mean_predicted_probability"),
            rate.alias("actual_churn_rate"),
            F.abs(mean_p - rate).alias("absolute_gap"),
        )
    )


def expected_calibration_error(table: DataFrame, cohort: Sequence[str]) -> DataFrame:
    """Gap of each bin weighted by its share of customers."""
    return table.groupBy(*cohort).agg((F.sum(F.col("n") * F.col("absolute_gap")) / F.sum("n")).alias("ece"))
