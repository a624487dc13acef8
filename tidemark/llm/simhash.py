"""SimHash near-duplicates found by the generalised pigeonhole principle.

Fingerprints of 64 bits link at ``max_distance`` or fewer differing bits. The bits are split into partitions that
hold correlated bits together, and each partition gets a threshold of its own, -1 (not probed) upwards. Whenever
the thresholds plus one add up to more than ``max_distance``, two linked fingerprints agree within the threshold in
at least one partition, so probing finds every link. Number of partitions and thresholds are chosen by dynamic
programming over candidate counts that are estimated from the fingerprints' own bits.

Equal fingerprints collapse to one before any probing. A probed signature that very many fingerprints share is dealt
out in blocks of bounded size, each pair of blocks being one unit of work; inside a unit the distances are computed
in numpy and only a spanning forest is returned, so nothing emits all pairs and no unit is unbounded.

Defined results: null, empty and white-space-only texts have no shingle and fingerprint zero, and link like any other;
texts of fewer words than a shingle have one shingle, the whole sequence; a null ``doc_id`` keeps its fingerprint and
takes the smallest id of its component (null if there is none); extra columns are ignored; an empty table gives an
empty result; repeated ``doc_id`` rows give one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import LOWER, UPPER, components, signed, slices, stored

BLOCK = 8  # bits of a block; partitions are made of whole blocks
FANOUT = 2048  # fingerprints of a signature that are compared in one unit of work, twice at most

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def text_fingerprint(text: str | None, shingle: int = 3) -> int:
    """The fingerprint of one text."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, stops = [0, *(ends[:-shingle]).tolist()], (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def row_key():
    """Tells rows apart by id and text; rows that agree in both are interchangeable."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("-")))


def fingerprints(docs: DataFrame, shingle: int = 3, keyed: bool = False) -> DataFrame:
    """``(doc_id, fp)`` of every document; ``fp`` holds the 64 bits as a long. ``keyed`` adds ``key``, see ``row_key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = np.array([text_fingerprint(t, shingle) for t in part.column("text").to_pylist()], np.uint64)
                names = ["doc_id", "fp", "key"] if keyed else ["doc_id", "fp"]
                yield pa.record_batch([pa.array(signed(fp)) if c == "fp" else part.column(c) for c in names], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *([row_key().alias("key")] if keyed else []))
    return rows.mapInArrow(run, "doc_id long, fp long" + (", key string" if keyed else ""))


# --- partitions and thresholds -------------------------------------------------------------------------------------


def _pair_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how often each two bits are set together (64 x 64, whatever the input)."""

    def run(batches):
        n, total = 0, np.zeros((64, 64))
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(fp, axis=1, bitorder="little").astype(np.float32)
            for at in range(0, len(bits), 1 << 16):
                x = bits[at : at + (1 << 16)]
                total += x.T @ x
            n += len(bits)
        yield pa.record_batch([pa.array(np.arange(4097)), pa.array(np.concatenate([total.ravel(), [n]]))], names=["cell", "x"])

    sums = distinct.select("fp").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(4097)
    for r in sums:
        flat[r.cell] = r.x
    return int(flat[-1]), flat[:-1].reshape(64, 64)


def correlated_blocks(n: int, together: np.ndarray) -> list[list[int]]:
    """The 64 bits in blocks of eight: each block grows by the bit most correlated with those it has."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    left, blocks = list(range(64)), []
    while left:
        block = [max(left, key=lambda b: (abs(p[b] - 0.5), -b))]  # the most one-sided bit still free
        left.remove(block[0])
        while len(block) < BLOCK:
            best = max(left, key=lambda b: (corr[b, block].sum(), -b))
            block.append(best)
            left.remove(best)
        blocks.append(block)
    return blocks


def gathered(fp, bits: list[int]):
    """SQL text: the given bits of column ``fp`` side by side in a long."""
    return " | ".join(f"shiftleft(shiftrightunsigned({fp}, {b}) & 1L, {i})" for i, b in enumerate(bits))


def _block_distances(distinct: DataFrame, blocks: list[list[int]]) -> np.ndarray:
    """For each block the share of pairs that differ there in 0..8 bits, from its counts of values (256 a block)."""
    spread = F.explode(F.array(*[F.struct(F.lit(i).alias("block"), F.expr(gathered("fp", b)).alias("v")) for i, b in enumerate(blocks)]))
    counts = distinct.select(spread.alias("x")).groupBy("x.block", "x.v").agg(F.count("*").alias("n")).collect()
    hist = np.zeros((len(blocks), 1 << BLOCK))
    for r in counts:
        hist[r.block, r.v] = r.n
    weight = np.array([bin(i).count("1") for i in range(1 << BLOCK)])
    xor = np.bitwise_xor.outer(np.arange(1 << BLOCK), np.arange(1 << BLOCK))
    out = np.zeros((len(blocks), BLOCK + 1))
    for i, h in enumerate(hist):
        joint = np.outer(h, h) / max(h.sum(), 1) ** 2
        out[i] = np.bincount(weight[xor].ravel(), joint.ravel(), minlength=BLOCK + 1)
    return out


def signatures_of(width: int, threshold: int) -> list[int]:
    """Bit masks of up to ``threshold`` flipped bits among ``width``."""
    return [sum(1 << b for b in c) for k in range(threshold + 1) for c in combinations(range(width), k)]


def plan(n: int, distances: np.ndarray, max_distance: int) -> list[tuple[list[int], int]]:
    """Partitions (as lists of blocks) and their thresholds, cheapest by estimated signatures and candidates."""
    best, cost, n = None, float("inf"), max(n, 2)
    count = len(distances)
    for m in range(1, min(count, max_distance + 1) + 1):
        edges = [round(i * count / m) for i in range(m + 1)]
        parts = [list(range(a, b)) for a, b in zip(edges, edges[1:])]
        prices = []
        for part in parts:
            law = np.ones(1)
            for b in part:
                law = np.convolve(law, distances[b])
            width = BLOCK * len(part)
            row = {-1: 0.0}
            for t in range(max_distance + 1):
                # Both sides flip half of the threshold (rounded up and down), so signatures meet.
                flips = sum(len(list(combinations(range(width), k))) for k in range((t + 1) // 2 + 1)) if t <= 2 else float("inf")
                row[t] = n * flips * 20.0 + n * n / 2 * law[: t + 1].sum()
            prices.append(row)
        need = max_distance + 1  # thresholds plus one must add up to this
        table = {0: (0.0, [])}
        for row in prices:
            grown: dict[int, tuple[float, list[int]]] = {}
            for have, (c, chosen) in table.items():
                for t, price in row.items():
                    key, total = min(need, have + t + 1), c + price
                    if key not in grown or total < grown[key][0]:
                        grown[key] = (total, [*chosen, t])
            table = grown
        if need in table and table[need][0] < cost:
            cost, best = table[need][0], list(zip(parts, table[need][1]))
    return best


# --- probing and verification --------------------------------------------------------------------------------------


def _forest(fp: np.ndarray, max_distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints: breadth first, so each one is compared once per tree node."""
    left = np.argsort(signed(fp), kind="stable")
    fp = fp[left]
    alive, out = np.arange(len(fp)), []
    while len(alive) > 1:
        queue, alive, root = [alive[0]], alive[1:], int(signed(fp[:1] * 0 + fp[alive[0]])[0])
        while queue and len(alive):
            near = np.bitwise_count(fp[alive] ^ fp[queue.pop()]) <= max_distance
            if near.any():
                found, alive = alive[near], alive[~near]
                queue.extend(found)
                out.extend((root, int(x)) for x in signed(fp[found]))
    return out


def _links_in_order(batches: Iterator[pa.RecordBatch], max_distance: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``unit``: the links of each unit, which has at most twice FANOUT rows."""

    def links(unit: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        sizes = np.diff(np.append(starts, len(unit)))
        row_size = np.repeat(sizes, sizes)
        small, shift = row_size <= 24, 1
        x, f = unit[small], fp[small]
        while len(x) > shift:  # small units: every row against the next ones
            hit = (x[shift:] == x[:-shift]) & (np.bitwise_count(f[shift:] ^ f[:-shift]) <= max_distance)
            a.append(signed(f[:-shift][hit]))
            b.append(signed(f[shift:][hit]))
            if not (x[shift:] == x[:-shift]).any():
                break
            shift += 1
        for s, n in zip(starts[sizes > 24], sizes[sizes > 24]):
            found = _forest(np.unique(fp[s : s + n]), max_distance)
            if found:
                pairs = np.array(found, np.int64)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        differ = a != b
        return pa.record_batch([pa.array(np.minimum(a, b)[differ]), pa.array(np.maximum(a, b)[differ])], names=["a", "b"])

    unit, fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        unit = np.concatenate([unit, batch.column("unit").to_numpy(zero_copy_only=False)])
        fp = np.concatenate([fp, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
        if not len(unit):
            continue
        last = int(np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))[-1])
        if last:
            yield links(unit[:last], fp[:last])
            unit, fp = unit[last:], fp[last:]
    if len(unit):
        yield links(unit, fp)


def fingerprint_links(distinct: DataFrame, max_distance: int = 3) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints at ``max_distance`` or fewer differing bits, and no others."""
    n, together = _pair_counts(distinct)
    blocks = correlated_blocks(n, together)
    probes = []
    for i, (part, threshold) in enumerate(plan(n, _block_distances(distinct, blocks), max_distance)):
        if threshold < 0:
            continue
        bits = [b for k in part for b in blocks[k]]
        value = F.expr(gathered("fp", bits))
        masks = signatures_of(len(bits), (threshold + 1) // 2)
        shifted = F.transform(F.array(*[F.lit(m).cast("long") for m in masks]), lambda m: F.xxhash64(F.lit(i), value.bitwiseXOR(m)))
        probes.append(shifted)
    keyed = distinct.select("fp", F.explode(F.concat(*probes)).alias("key")).distinct()
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # A signature with many rows becomes pairs of blocks: block c meets every block d in unit (min, max).
    chunks = F.ceil(F.col("n") / F.lit(FANOUT)).cast("long")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), "chunks")
    units = (
        keyed.join(sizes, "key")
        .withColumn("chunks", chunks)
        .withColumn("own", own)
        .select("fp", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
        .select("fp", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"))
    )
    dealt = units.repartition("unit").sortWithinPartitions("unit", "fp")
    return dealt.mapInArrow(lambda batches: _links_in_order(batches, max_distance), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3, keyed: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``fp``, ``component_id`` (the smallest doc_id reachable over links) and ``component``.

    ``keyed`` adds ``key``, see ``row_key``.
    """
    fps = stored(fingerprints(docs, shingle, keyed), "simhash-fp")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(fingerprint_links(distinct.select("fp"), max_distance), "simhash-links")
    named = distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = stored(named.join(smallest, "root").select("fp", "component_id", F.col("root").alias("component")), "simhash-ids")
    return fps.join(ids, "fp").select("doc_id", "fp", "component_id", "component", *(["key"] if keyed else []))


def without_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 3) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id (a null id only if there is no other)."""
    found = near_duplicates(docs, shingle, max_distance, keyed=True)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key")).alias("best")
    kept = found.groupBy("component").agg(best).select(F.col("best.key").alias("kept_key"))
    # The document's own columns may have any name, so they travel as one.
    rows = docs.select(row_key().alias("kept_key"), F.struct("*").alias("own")).join(kept, "kept_key", "left_semi")
    # Of rows that agree in id and text one is enough; the join has already brought them together.
    first = rows.withColumn("kept_place", F.row_number().over(Window.partitionBy("kept_key").orderBy(F.lit(0))))
    return first.where("kept_place = 1").select("own.*")


def op6_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3, max_distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
