"""Hard negatives of anchor rows by slot-decomposed selection.

An anchor's positives each open a window of scores, ``low`` to ``high`` percent of the positive's own score, in which
the best rows of other labels are wanted. The windows overlap, but their upper limits split the scores into disjoint
slots. Whatever window asks, its best rows are the best of the slots from its limit downwards, so it is enough to keep
the best rows of every slot: those can be combined in any order, inside a task first, and then between tasks. One merge
of an anchor's slots in descending order answers all its windows.

Anchors are a stated query set against all rows, in blocks: rows are dealt into lanes and anchors into stripes, both of
bounded size, and each (stripe, lane) is one group with a product of two small matrices. Rows are dealt by their place
in a written table, so neither a label nor an id that holds a third of all rows makes a lane larger. The first pass finds
the positives, the second the slots; after each, the survivors of a lane are reduced by a ranked window per anchor, which
Spark limits before the shuffle.

Defined results: a row without an id, a label or a vector, or with a null or non-finite component, takes no part; other
rows of an anchor are those with another id, and rows that repeat an id are rows of their own (as anchors, each gives its
own results); components missing in the shorter of two vectors count as zero; scores are exact, and those beyond 2^56
count as 2^56; a window whose lower limit is above its upper one (negative scores) has no rows; anchors without positives
or negatives give no row; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import stored, table

LOW, HIGH = 50, 95  # percent of a positive's score
POSITIVES, NEGATIVES = 5, 3
STEPS = 256  # of a component, which is rounded down to them

BLOCK = 32_768  # rows of a lane, anchors of a stripe
BLOCK_BYTES = 32 << 20  # of either, as 8-byte components
SCORES = 1 << 22  # that are looked at together
LARGEST = 1 << 56
NOTHING = np.iinfo(np.int64).min


def _steps(vectors: pa.ChunkedArray) -> np.ndarray:
    """A matrix of the components in steps: exact doubles, or Python integers where doubles would not be exact."""
    vectors = vectors.combine_chunks()
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    small = not len(flat) or np.abs(flat).max() < 2.0**45 / STEPS
    out = np.zeros((len(lengths), lengths.max(initial=0)), np.float64 if small else object)
    inside = np.arange(out.shape[1]) < lengths[:, None]
    out[inside] = np.floor(flat * STEPS) if small else [math.floor(x * STEPS) if abs(x) < 1e300 else int(x) * STEPS for x in flat.tolist()]
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all of ``b``, exact up to the largest score."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if a.dtype != object and b.dtype != object and float(np.abs(a).max()) * float(np.abs(b).max()) * width < 2.0**53:
        out = a @ b.T
        return np.clip(out, -LARGEST, LARGEST).astype(np.int64)
    whole = [[int(x) for x in row] for row in a.tolist()], [[int(x) for x in row] for row in b.tolist()]
    return np.array([[max(-LARGEST, min(LARGEST, sum(map(int.__mul__, x, y)))) for y in whole[1]] for x in whole[0]], np.int64)


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` best entries of each row (fewer if there are not as many); columns break ties."""
    n = scores.shape[1]
    least = np.partition(scores, n - k, axis=1)[:, n - k, None] if n > k else np.full((len(scores), 1), NOTHING)
    row, column = np.nonzero((scores >= least) & (scores != NOTHING))
    order = np.lexsort((column, ~scores[row, column], row))
    row, column = row[order], column[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return row[rank < k], column[rank < k]


def _blocks(anchors: pa.Table, rows: pa.Table, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of anchors and rows, and scores, for all pairs of equal (or of different) labels, some at a time."""
    ids, labels = (rows.column(c).to_numpy() for c in ("vec_id", "label"))
    order = np.argsort(ids, kind="stable")  # so that columns are in the order of a tie
    vectors, anchor_vectors, anchor_labels = _steps(rows.column("vector")), _steps(anchors.column("vector")), anchors.column("label").to_numpy()
    for label in np.unique(anchor_labels):
        own = np.flatnonzero(anchor_labels == label)
        others = order[(labels[order] == label) == same]
        if not len(others):
            continue
        right = vectors[others]
        for at in range(0, len(own), max(1, SCORES // len(others))):
            some = own[at : at + max(1, SCORES // len(others))]
            yield some, others, _scores(anchor_vectors[some], right)


def positives_of(k: int) -> Callable:
    def find(_key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, own, place = rows.column("vec_id").to_numpy(), anchors.column("vec_id").to_numpy(), anchors.column("place").to_numpy()
        out = [np.zeros((3, 0), np.int64)]
        if rows.num_rows and anchors.num_rows:
            for a, b, scores in _blocks(anchors, rows, True):
                scores[own[a][:, None] == ids[b]] = NOTHING
                row, column = _best(scores, k)
                out.append(np.stack([place[a[row]], ids[b[column]], scores[row, column]]))
        return pa.table(dict(zip(("place", "vec_id", "score"), np.concatenate(out, axis=1))))

    return find


def slots_of(k: int) -> Callable:
    def find(_key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        ids, place = rows.column("vec_id").to_numpy(), anchors.column("place").to_numpy()
        out = [np.zeros((4, 0), np.int64)]
        if rows.num_rows and anchors.num_rows:
            lists = anchors.column("limits").to_pylist()
            limits = np.full((len(lists), max(map(len, lists)) + 1), NOTHING)  # descending; the last one is below all
            for i, x in enumerate(lists):
                limits[i, : len(x)] = x
            lowest = anchors.column("lowest").to_numpy()
            for a, b, scores in _blocks(anchors, rows, False):
                scores[scores < lowest[a][:, None]] = NOTHING
                for slot in range(limits.shape[1] - 1):
                    inside = np.where((scores <= limits[a, slot][:, None]) & (scores > limits[a, slot + 1][:, None]), scores, NOTHING)
                    row, column = _best(inside, k)
                    out.append(np.stack([place[a[row]], np.full(len(row), slot), ids[b[column]], inside[row, column]]))
        return pa.table(dict(zip(("place", "slot", "vec_id", "score"), np.concatenate(out, axis=1))))

    return find


def _per_cell(rows: DataFrame, anchors: DataFrame, stripes: int, lanes: int, find: Callable, schema: str) -> DataFrame:
    """``find`` on every pair of a stripe of anchors and a lane of rows."""
    deal = lambda n: F.pmod(F.xxhash64("place"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("stripe", deal(stripes)).withColumn("lane", every(lanes))
    r = rows.withColumn("lane", deal(lanes)).withColumn("stripe", every(stripes))
    return r.groupBy("stripe", "lane").cogroup(a.groupBy("stripe", "lane")).applyInArrow(find, schema)


def _first(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def _percent(score: Column, percent: int) -> Column:
    """``percent`` percent of the score, rounded down."""
    x = score * F.lit(percent)
    return F.call_function("div", x - F.pmod(x, F.lit(100)), F.lit(100))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``anchor`` is a condition on ``vec_id``.
    """
    spark = vectors.sparkSession
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
    # A place is given once and written, so that a task that is run again deals alike.
    rows = stored(rows.dropna().where(finite).withColumn("place", F.monotonically_increasing_id()), "negatives-rows")
    anchors = stored(rows.where(anchor), "negatives-anchors")
    n, wide = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    block = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, wide or 0))))
    lanes = max(1, -(-n // block), min(spark.sparkContext.defaultParallelism, n // 2048))
    stripes = max(1, -(-anchors.count() // block))

    pairs = _per_cell(rows, anchors, stripes, lanes, positives_of(positives), "place long, vec_id long, score long")
    score = F.col("score")
    found = _first(pairs, ["place"], positives).select(
        "place", F.col("vec_id").alias("positive_id"), score.alias("positive_score"), (-_percent(-score, low)).alias("floor"), _percent(score, high).alias("limit")
    )
    found = stored(found, "negatives-positives")
    windows = found.where("floor <= limit")
    limits = windows.groupBy("place").agg(F.sort_array(F.collect_set("limit"), False).alias("limits"), F.min("floor").alias("lowest"))
    kept = _per_cell(rows, anchors.join(limits, "place"), stripes, lanes, slots_of(negatives), "place long, slot long, vec_id long, score long")
    # Slots from high to low, the best of each: a window reads on from its limit.
    best = _first(kept, ["place", "slot"], negatives).groupBy("place").agg(
        F.array_sort(F.collect_list(F.struct((-score).alias("order"), F.col("vec_id").alias("negative_id")))).alias("best")
    )
    inside = F.filter("best", lambda x: (-x["order"] <= F.col("limit")) & (-x["order"] >= F.col("floor")))
    chosen = windows.join(best, "place").join(anchors.select("place", F.col("vec_id").alias("anchor_id")), "place")
    chosen = chosen.select("anchor_id", "positive_id", "positive_score", F.posexplode(F.slice(inside, 1, negatives)).alias("at", "negative"))
    return chosen.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("negative.negative_id").alias("negative_id"),
        "positive_score",
        (-F.col("negative.order")).alias("negative_score"),
    )


def op11_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP11_SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
    FROM rows a JOIN rows r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id
),
positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS place
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
    WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE place <= 3
"""
