"""Helpers that several operators share: stored tables, word splitting in numpy, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import _bytes, shared_dir

#: The white space that separates words, as code points and as a class for patterns.
SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text that a task handles at a time, so that memory follows this and one text, not the batch.
SLICE_BYTES = 4 << 20

#: Bytes that go to a Python worker at a time: one slice, a text more or less.
BATCH_BYTES = SLICE_BYTES - (SLICE_BYTES >> 4)
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get rows by bytes, not 10,000 at a time: executor and worker both hold the whole batch.

    The session's setting is only ever tightened.
    """
    now = spark.conf.get(_BATCH)
    if now.startswith("-") or _bytes(now) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the folder that all executors share, and read back."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``limit`` bytes of text (at least one row each)."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of ``texts``, the code of each word in order, and where each text's words start (n + 1 places).

    A word is a run without ASCII white space; a null text has none.
    """
    parts = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(flat), 0)
    keep = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False), dtype=np.int64)])
    coded = flat.filter(full).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), keep[offsets]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of a sequence in constant time: polynomials modulo 2^64 over scrambled 64-bit units."""

    BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

    _powers: dict[tuple[int, bool], np.ndarray] = {}

    @classmethod
    def powers(cls, lane: int, inverse: bool, n: int) -> np.ndarray:
        """1, b, b^2, ...; kept for the longest sequence so far."""
        if len(cls._powers.get((lane, inverse), ())) < n:
            out = np.full(n, pow(cls.BASES[lane], -1, 1 << 64) if inverse else cls.BASES[lane], np.uint64)
            out[0] = 1
            cls._powers[lane, inverse] = np.multiply.accumulate(out)
        return cls._powers[lane, inverse][:n]

    def __init__(self, units: np.ndarray, lane: int):
        n = len(units)
        self.inverse = self.powers(lane, True, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(units * self.powers(lane, False, n + 1)[:n], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))


#: Two independent 64-bit values for each byte.
BYTES = mixed(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(2, 256)
LONG_WORD = 64


def word_hashes(words: pa.Array, lane: int) -> np.ndarray:
    """A 64-bit hash of each word, by the polynomials above; words too long for them one by one. Lanes are independent."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(words) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(words) else np.zeros(1, np.int64)
    out = Rolling(BYTES[lane][data], lane).of(offsets[:-1], offsets[1:])
    for i in np.flatnonzero(np.diff(offsets) > LONG_WORD):
        out[i] = (xxhash.xxh3_128_intdigest(data[offsets[i] : offsets[i + 1]].tobytes()) >> (64 * lane)) & 0xFFFFFFFFFFFFFFFF
    return out


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges (a, b)``; root is the smallest node reachable.

    Rounds of contraction: each node joins its smallest neighbour if that is smaller, chains are followed to
    their end, and the edges are rewritten between what is left. Every round is written to the shared folder.
    Groups of neighbours are only ever reduced to a minimum, so a node with many links costs no more than its rows.
    """
    edges = stored(edges.where("a <> b").select("a", "b").distinct(), label)
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root"))
        parent = stored(parent, label)
        while True:  # follow chains; their length halves
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            step = stored(parent.join(up, "root").select("node", F.col("higher").alias("root"), (F.col("higher") != F.col("root")).alias("moved")), label)
            parent = step.select("node", "root")
            if step.where("moved").isEmpty():
                break
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        if labels is None:
            labels = parent
        else:
            moved = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            labels = stored(labels.join(moved, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), label)
        edges = stored(edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), label)
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
