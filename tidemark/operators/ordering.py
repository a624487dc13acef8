"""Exact order statistics and running totals without putting a group into one task.

Values fall into *bands* and bands into *cells* (functions.numeric.order_cell at two densities). Both
depend on the value alone, so every branch of a plan and every retried task agrees on them. Equal
values collapse first, on the map side. Then three bounded orderings replace one unbounded one: the
bands of a group, the cells of a band, and the values of a cell, the only one that sees the data and
at a relative width below 1e-7. A band that holds a third of all rows spreads over its cells.

The groups are planning keys (snapshot, feature, model version, role): their number follows the
calendar, not the facts.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.numeric import BAND_DENSITY, CELL_DENSITY, order_cell
from tidemark.session import written

#: Characters by which a crowded cell of texts is split at a time, rows that a cell may keep, and cells a round may broadcast.
TEXT_STEP, TEXT_CELL, TEXT_BROADCAST = 3, 1024, 100_000


def _upto(keys: Sequence[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _whole(keys: Sequence[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _by_cell(df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Running totals of groups that each lie within one band; and the sums of their cells, ``<m>_cell``."""
    k, mine = list(keys), [*keys, "cell"]
    cell = order_cell(F.col(order[0]), CELL_DENSITY).alias("cell")
    vals = df.groupBy(*k, cell, *order).agg(*[F.sum(m).alias(m) for m in measures])
    vals = vals.select("*", *[(F.sum(m).over(_upto(mine, *order)) - F.col(m)).alias(f"{m}_inside") for m in measures])
    totals = vals.groupBy(*mine).agg(*[F.sum(m).alias(f"{m}_cell") for m in measures])
    offsets = totals.select(
        *mine,
        *[(F.sum(f"{m}_cell").over(_upto(k, "cell")) - F.col(f"{m}_cell")).alias(f"{m}_before") for m in measures],
        *[F.sum(f"{m}_cell").over(_whole(k, "cell")).alias(f"{m}_total") for m in measures],
    )
    inner = vals.join(offsets, mine).select(
        *k,
        *order,
        *measures,
        *[(F.col(f"{m}_before") + F.col(f"{m}_inside")).alias(f"{m}_below") for m in measures],
        *[f"{m}_total" for m in measures],
    )
    return inner, totals


def running_totals(df: DataFrame, group: Sequence[str], order: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per (group, order) with each measure's sum, ``<m>_below`` and group ``<m>_total``.

    ``<m>_below`` sums everything strictly before the row in the order. The first order column must be
    numeric: it decides the band and the cell.
    """
    g = list(group)
    banded = df.withColumn("band", order_cell(F.col(order[0]), BAND_DENSITY))
    inner, cells = _by_cell(banded, [*g, "band"], order, measures)
    # From the cells, which the join has already, and not from its result, which would be made twice. Rows without a value have no rank.
    sums = cells.groupBy(*g, "band").agg(F.count("cell").alias("cells"), *[F.sum(f"{m}_cell").alias(f"{m}_band") for m in measures]).where("cells > 0")
    bands = sums.select(
        *g,
        "band",
        *[(F.sum(f"{m}_band").over(_upto(g, "band")) - F.col(f"{m}_band")).alias(f"{m}_earlier") for m in measures],
        *[F.sum(f"{m}_band").over(_whole(g, "band")).alias(f"{m}_all") for m in measures],
    )
    # A thousand bands per e-fold of the values and per group, however many rows there are.
    return inner.join(F.broadcast(bands), [*g, "band"]).select(
        *g,
        *order,
        *measures,
        *[(F.col(f"{m}_earlier") + F.col(f"{m}_below")).alias(f"{m}_below") for m in measures],
        *[F.col(f"{m}_all").alias(f"{m}_total") for m in measures],
    )


def text_ranks(df: DataFrame, group: Sequence[str], text: str, most: int = TEXT_CELL) -> DataFrame:
    """``df`` with ``rows_below``: the rows of the group before this one in the order of ``text``, which is unique in a group.

    A cell (``depth``, ``cell``) is the rows whose first ``depth`` characters are ``cell``. One with more than ``most`` rows
    is split by the characters that follow the beginning which all its texts share, and so on until each fits or holds
    one text only. Counts drive the rounds: a common beginning of any length costs none, and rows that lie in
    cells that fit take part in no further one. Only the rows of a cell are ordered together. NULL comes first.
    """
    g = list(group)
    key = [*g, "depth", "cell"]
    value = F.coalesce(F.col(text), F.lit(""))
    rows = written(df.withColumns({"depth": F.lit(0), "cell": F.lit(""), "ahead": F.lit(0).cast("long")}), "text-rows")
    placed = None
    while True:
        cells = rows.groupBy(*key, "ahead").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count("*").alias("size"))
        before = F.col("ahead") + F.sum("size").over(_upto([*g, "ahead"], "cell")) - F.col("size")
        cells = written(cells.withColumn("before", before), "text-cells")
        done = (F.col("size") <= most) | (F.col("lo") == F.col("hi"))
        split = cells.where(~done).select(*key, (_common("lo", "hi") + TEXT_STEP).alias("next"), "before")
        waiting = split.count()
        if 0 < waiting <= TEXT_BROADCAST:  # few cells may hold nearly all rows, so these stay where they are
            split = F.broadcast(split)
        rest = rows.join(split.select(*key), key, "left_anti") if waiting else rows
        fit = rest.drop("ahead").join(cells.where(done).select(*key, "before"), key)
        placed = fit if placed is None else placed.unionByName(fit)
        if not waiting:
            break
        deeper = rows.drop("ahead").join(split, key).withColumn("cell", value.substr(F.lit(1), F.col("next")))
        rows = written(deeper.drop("depth").withColumnsRenamed({"next": "depth", "before": "ahead"}), "text-rows")
    inside = F.row_number().over(Window.partitionBy(*key).orderBy(F.col(text).asc_nulls_first()))
    return placed.withColumn("rows_below", F.col("before") + inside - 1).drop("before")


def _common(a: str, b: str) -> Column:
    """Length of the beginning that two texts share."""
    longest = F.least(F.length(a), F.length(b))
    lengths = F.when(longest > 0, F.sequence(F.lit(1), longest)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(lengths, lambda n: F.col(a).substr(F.lit(1), n) == F.col(b).substr(F.lit(1), n)))


def quantiles(df: DataFrame, group: Sequence[str], value: str, points: Sequence[float]) -> DataFrame:
    """Exact linear-interpolation quantiles: one row per group with ``n`` and an array ``q``.

    First pass: rows per band, which tells the bands that hold the wanted ranks. Second pass: the
    values of those bands only. NULL values do not count; a group without values has no row.
    """
    g = list(group)
    rows = df.where(F.col(value).isNotNull()).withColumn("band", order_cell(F.col(value), BAND_DENSITY))
    per_band = rows.groupBy(*g, "band").agg(F.count("*").alias("size"))
    pos = F.transform(F.array(*[F.lit(float(p)) for p in points]), lambda p: p * (F.col("n") - 1))
    ranks = F.array_distinct(F.concat(F.transform(pos, lambda p: F.floor(p)), F.transform(pos, lambda p: F.ceil(p))))

    def holds(first: Column, count: Column) -> Column:
        """Does [first, first + count) hold a wanted rank? Plain comparisons, as it is asked of many rows."""
        at_point = [F.lit(float(p)) * (F.col("n") - 1) for p in points]
        return functools.reduce(operator.or_, [(F.floor(x) < first + count) & (F.ceil(x) >= first) for x in at_point])

    # The bands that hold a wanted rank: at most two per point and group, small enough for every task.
    wanted = per_band.select(
        *g,
        "band",
        "size",
        F.sum("size").over(_whole(g, "band")).alias("n"),
        (F.sum("size").over(_upto(g, "band")) - F.col("size")).alias("before"),
    ).where(holds(F.col("before"), F.col("size")))
    wanted = F.broadcast(wanted.drop("size"))
    copies, first = F.col("copies"), F.col("first")
    inside, _ = _by_cell(rows.join(wanted, [*g, "band"], "left_semi").withColumn("copies", F.lit(1)), [*g, "band"], [value], ["copies"])
    found = (
        inside.join(wanted, [*g, "band"])
        .withColumn("first", F.col("before") + F.col("copies_below"))
        .where(holds(first, copies))
        .withColumn("rank", F.explode(F.filter(ranks, lambda r: (r >= first) & (r < first + copies))))
    )
    at = found.groupBy(*g).agg(F.max("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("rank", value))).alias("at"))
    return at.select(*g, "n", F.transform(pos, lambda p: _between(F.col("at"), p)).alias("q"))


def _between(at: Column, pos: Column) -> Column:
    """Linear interpolation, anchored at the nearer end so that equal ends give that very value."""
    lo, hi, t = at[F.floor(pos)], at[F.ceil(pos)], pos - F.floor(pos)
    return F.when(t < 0.5, lo + (hi - lo) * t).otherwise(hi - (hi - lo) * (1 - t))
