"""Periodic runs of words by enumeration of maximal pairs.

A run of period q and length n is a pair of equal stretches of n - q words, q apart, that no common word extends to either
side. All such maximal pairs follow from the tree of common-prefix intervals over the sorted suffixes of a text: scanned
bottom-up, an interval of common prefix l collects the places of its children, smaller lists into larger ones, in the
order of the text and with the class of each place, the word to its left. Two places pair up if the words to their left and
the words after l differ, and if their distance q and l satisfy the length constraints. As l is then at least 2q, the
stretches overlap so much that a place between two places of an interval would mean a smaller period; so only neighbours in
a list are looked at, and a pair is a run as it stands: nothing is extended. Intervals below the least common prefix that
a run can have are never opened.

Texts without any repeated stretch of that length have no run; a rolling hash sets them aside (equal stretches have
equal hashes, so none is missed), and only the others get suffixes. Suffixes are sorted by doubling ranks, common prefixes
counted word by word, so runs themselves depend on no hash.

Defined results: null, empty and wordless texts have no words and no runs; repeated rows, repeated and null ids are rows of their own;
extra columns are ignored; an empty table gives an empty result. A task holds the words of one slice, or of one text if that
is longer, at about a hundred times their number in bytes where it has repeats.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Rolling, mixed, slices, table, words_of

SHORTEST, PERIODS = 24, 3  # words of a run, and how often at least it holds its period
SLICE = 2 << 20


def least_prefix(shortest: int, periods: int) -> int:
    """The least common prefix of the maximal pair of any run."""
    return min(max(shortest - q, (periods - 1) * q) for q in range(1, shortest + 1))


def suffix_order(units: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by doubling: ranks by the first k units refine those that still tie by the next k."""
    order = np.argsort(units, kind="stable")
    head = np.append(True, np.diff(units[order]) != 0)
    rank = np.empty(len(units), np.int64)  # of a group of ties: the place of its first suffix
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(len(units)), 0))
    k = 1
    while True:
        tied = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(tied):
            return order
        suffix = order[tied]
        then = np.where(suffix + k < len(units), rank[np.minimum(suffix + k, len(units) - 1)], -1)
        group = rank[suffix]
        sort = np.lexsort((then, group))
        suffix, then, group = suffix[sort], then[sort], group[sort]
        order[tied] = suffix
        head[tied] = np.append(True, (np.diff(group) != 0) | (np.diff(then) != 0))
        rank[suffix] = np.maximum.accumulate(np.where(head[tied], tied, 0))
        k *= 2


def common_prefixes(units: list[int], order: np.ndarray) -> list[int]:
    """Units that each suffix in order shares with the one before it, in linear time as a prefix loses one unit a step at most."""
    before = np.full(len(order), -1)
    before[order[1:]] = order[:-1]
    out, shared, end = [0] * len(units), 0, len(units)
    for i, j in enumerate(before.tolist()):
        if j < 0:
            shared = 0
            continue
        top = end - max(i, j)
        while shared < top and units[i + shared] == units[j + shared]:
            shared += 1
        out[i] = shared
        if shared:
            shared -= 1
    return np.array(out)[order].tolist()


def maximal_pairs(units: np.ndarray, shortest: int, periods: int) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs in ``units``.

    No run contains the first unit, nor one that occurs once; such units separate texts.
    """
    least = least_prefix(shortest, periods)
    order, text = suffix_order(units), units.tolist()
    found: dict[tuple[int, int], int] = {}

    def paired(a: int, b: int, prefix: int) -> None:
        q = b - a
        if (periods - 1) * q <= prefix and prefix + q >= shortest and text[a - 1] != text[b - 1] and (b + prefix == len(text) or text[a + prefix] != text[b + prefix]):
            # While children are still missing, a multiple of the period can pair up too.
            found[a, prefix + q] = min(q, found.get((a, prefix + q), q))

    def joined(a: list[int], b: list[int], prefix: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        for place in b:
            k = bisect_left(a, place)
            if k:
                paired(a[k - 1], place, prefix)
            if k < len(a):
                paired(place, a[k], prefix)
            a.insert(k, place)
        return a

    open_: list[tuple[int, list[int]]] = []  # common prefix and places of intervals that may go on
    places: list[int] = []
    for suffix, prefix in zip(order.tolist() + [-1], common_prefixes(text, order) + [0]):
        while open_ and open_[-1][0] > prefix:
            depth, own = open_.pop()
            places = joined(own, places, depth)
        if prefix >= least:
            if open_ and open_[-1][0] == prefix:
                open_[-1] = (prefix, joined(open_[-1][1], places, prefix))
            else:
                open_.append((prefix, places))
        places = [suffix]
    return [(start, length, period) for (start, length), period in found.items()]


def _repeating(codes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Which texts may hold a stretch of ``window`` words twice."""
    lengths = np.diff(starts)
    count = np.maximum(lengths - window + 1, 0)
    text = np.repeat(np.arange(len(lengths)), count)
    place = starts[text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    key = mixed(Rolling(mixed(codes.astype(np.uint64) + np.uint64(1)), 0).of(place, place + window) + np.uint64(0x9E3779B97F4A7C15) * text.astype(np.uint64))
    order = np.argsort(key, kind="stable")
    twice = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    out = np.zeros(len(lengths), bool)
    out[text[order[twice]]] = True
    return out


def periodic_runs(
    docs: DataFrame, shortest: int = SHORTEST, periods: int = PERIODS, rearranged: Callable[[int | None, int], np.ndarray | None] | None = None
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (array of start, length, period; in this order) and ``collapsed``: the text's words without those that
    a run repeats, joined by spaces.

    ``periods`` is at least 3. ``rearranged(doc_id, n_words)`` may give the words to read instead, by number.
    """
    if periods < 3:
        raise ValueError("neighbouring places are runs only if these hold their period three times")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, limit=SLICE):
                words, codes, starts = words_of(some.column("text"))
                if rearranged:
                    for doc, a, b in zip(some.column("doc_id").to_pylist(), starts[:-1].tolist(), starts[1:].tolist()):
                        order = rearranged(doc, b - a)
                        if order is not None:
                            codes[a:b] = codes[a + order]
                yield _runs_of(some.column("doc_id"), words, codes, starts, shortest, periods)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def _runs_of(ids: pa.Array, words: pa.Array, codes: np.ndarray, starts: np.ndarray, shortest: int, periods: int) -> pa.RecordBatch:
    texts = np.flatnonzero(_repeating(codes, starts, least_prefix(shortest, periods)))
    found = np.zeros((0, 3), np.int64)
    if len(texts):
        # Texts side by side, each after a unit of its own, and no unit in two texts.
        lengths = (starts[1:] - starts[:-1])[texts]
        own = np.repeat(np.arange(len(texts)), lengths)
        first = np.cumsum(lengths) - lengths
        from_at = np.repeat(starts[:-1][texts] - first, lengths) + np.arange(len(own))
        at = np.arange(len(own)) + own + 1
        units = np.zeros(len(own) + len(texts), np.int64)
        units[at] = np.unique(own * np.int64(len(words)) + codes[from_at], return_inverse=True)[1]
        units[first + np.arange(len(texts))] = len(own) + np.arange(len(texts))
        runs = np.array(sorted(maximal_pairs(units, shortest, periods)), np.int64).reshape(-1, 3)
        place = np.searchsorted(at, runs[:, 0])
        found = np.column_stack([from_at[place], runs[:, 1:]])
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(gone[:-1]) == 0
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    text = np.searchsorted(starts, found[:, 0], "right") - 1
    offsets = pa.array(np.searchsorted(text, np.arange(len(starts))), pa.int32())
    fields = pa.StructArray.from_arrays([pa.array(found[:, 0] - starts[text]), pa.array(found[:, 1]), pa.array(found[:, 2])], names=["start", "length", "period"])
    left = np.concatenate([[0], np.cumsum(kept)])
    lists = pa.LargeListArray.from_arrays(pa.array(left[starts], pa.int64()), words.take(pa.array(codes[kept])))
    collapsed = pc.binary_join(lists, pa.scalar(" ", words.type)).cast(pa.string())
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts)), pa.ListArray.from_arrays(offsets, fields), collapsed], names=["doc_id", "n_words", "runs", "collapsed"])


def strongest(runs: Column) -> Column:
    """The run that holds its period most often, the first of equal ones; null if there is none."""
    more = lambda best, x: x["length"] * best["period"] > best["length"] * x["period"]
    return F.aggregate(runs, runs[0], lambda best, x: F.when(more(best, x), x).otherwise(best))


def planted(doc: int | None, n: int) -> np.ndarray | None:
    """The rearrangement that the query asks for in one of ten documents: from some word on, the next few repeat."""
    h = None if doc is None else zlib.crc32(str(doc).encode())
    if h is None or h % 10 or not n:
        return None
    a = h // 10 % n
    period = 1 + (n - a) // (3 + h // 10 % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % period])


def op12_runs(spark, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), rearranged=planted)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("best")
    return found.withColumn("best", F.when(F.size("runs") > 0, strongest(F.col("runs")))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
