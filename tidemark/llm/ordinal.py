"""A graded quality classifier: ordinal regression with cumulative links.

Grades are ordered; one weight vector over hashed words is shared by all of them and increasing thresholds cut its
value: P(grade <= k) = sigmoid(threshold_k - w.x). Grades here are 0 (label quality 0), 1 (quality 1 but toxic) and 2
(quality 1, not toxic). The expected grade and the probability of at least grade 1 come out for every document; a
document is selected where that probability reaches a threshold at which at most ``LOST`` of the training rows of
grade 1 or more are lost.

Fitted on all labelled rows outside the held-out fold, by averaging models (iterations on a shard of about ``SHARD_ROWS``
rows, weights and cuts averaged over the shards); the threshold is an exact quantile over all of them. A text has at most ``BUCKETS`` features. Defined
results: null, empty and wordless texts have one feature that says so; without training rows of two grades every
document gets the shares of the grades (grade 0 without any rows) and is selected by the same threshold; repeated
rows score alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, stored, table, words_of
from tidemark.llm.labelled import held_out, labelled_rows, ranked

#: Labelled rows that are fitted together, about; more of them are dealt into shards by a hash of the id.
SHARD_ROWS = 6_000
BUCKETS = 1 << 14
GRADES = 3
LOST = 0.005

_SHAPE = [(re.compile(r"[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile(r"[a-zß-öø-ÿ]+"), "a"), (re.compile(r"[0-9]+"), "9"), (re.compile(r"([^Aa9])\1+"), r"\1")]


def _buckets(word: str) -> list[int]:
    shape = word
    for pattern, sign in _SHAPE:
        shape = pattern.sub(sign, shape)
    return [xxhash.xxh3_64_intdigest("w" + word.lower()) % BUCKETS, xxhash.xxh3_64_intdigest("s" + shape) % BUCKETS]


def _named(name: str) -> int:
    return xxhash.xxh3_64_intdigest("n" + name) % BUCKETS


class Hasher:
    """Sparse features of texts: log counts of hashed words and shapes to unit length, and marks for length and variety."""

    def __init__(self):
        self.known: dict[str, list[int]] = {}

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        words, codes, starts = words_of(texts)
        names = words.to_pylist()
        if len(self.known) > 400_000:
            self.known.clear()
        for w in names:
            if w not in self.known:
                self.known[w] = _buckets(w)
        of = np.array([self.known[w] for w in names], np.int64).reshape(-1, 2)
        for a, b in zip(starts[:-1], starts[1:]):
            n = int(b - a)
            own = codes[a:b]
            index, counts = np.unique(of[own].ravel(), return_counts=True) if n else (np.zeros(0, np.int64), np.zeros(0))
            value = np.log1p(counts)
            value = value / max(np.sqrt((value**2).sum()), 1e-9)
            variety = int(10 * len(np.unique(own)) / n) if n else -1
            marks = np.array([_named(f"variety {variety}"), _named(f"length {int(np.log2(n + 1))}")])
            yield np.concatenate([index, marks]), np.concatenate([value, [0.5, 0.5]]).astype(np.float32)


class CumulativeLink:
    def __init__(self, weights: np.ndarray, cuts: np.ndarray):
        self.weights, self.cuts = weights, cuts

    @classmethod
    def fit(cls, row: np.ndarray, index: np.ndarray, value: np.ndarray, grade: np.ndarray, steps: int = 120, rate: float = 0.3, ridge: float = 2e-5):
        """Gradient steps (Adam) on the likelihood; later cuts are the first plus positive gaps."""
        n = len(grade)
        share = np.clip(np.array([(grade <= k).mean() for k in range(GRADES - 1)]), 0.01, 0.99)
        start = np.log(share / (1 - share))
        raw = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.05))])
        w = np.zeros(BUCKETS)
        moments = [(np.zeros_like(w), np.zeros_like(w)), (np.zeros_like(raw), np.zeros_like(raw))]
        for step in range(1, steps + 1):
            cuts = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
            z = np.bincount(row, value * w[index], minlength=n)
            edge = 1 / (1 + np.exp(-np.clip(np.concatenate([[-60.0], cuts, [60.0]])[None, :] - z[:, None], -60, 60)))
            low, high = edge[np.arange(n), grade], edge[np.arange(n), grade + 1]
            p = np.maximum(high - low, 1e-12)
            dz = (high * (1 - high) - low * (1 - low)) / p / n  # of minus the log likelihood
            dcut = np.zeros(GRADES - 1)
            for k in range(GRADES - 1):
                dcut[k] = (low * (1 - low) / p)[grade == k + 1].sum() / n - (high * (1 - high) / p)[grade == k].sum() / n
            gaps = np.concatenate([[1.0], np.exp(raw[1:])])
            draw = np.cumsum(dcut[::-1])[::-1] * gaps
            dw = np.bincount(index, value * dz[row], minlength=BUCKETS) + ridge * w
            for x, g, (m, v) in zip((w, raw), (dw, draw), moments):
                m *= 0.9
                m += 0.1 * g
                v *= 0.99
                v += 0.01 * g * g
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return cls(w, np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])])))

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, per value."""
        return 1 - 1 / (1 + np.exp(-np.clip(self.cuts[None, :] - z[:, None], -60, 60)))


_FEATURES = "doc_id long, shard int, grade int, i binary, v binary"


def _averaged(train: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and cuts fitted on each shard of the rows, averaged by its rows; None without a shard of two grades."""

    def fitted(group: pa.Table) -> pa.Table:
        group = group.sort_by("doc_id")
        y = group.column("grade").to_numpy().astype(np.int64)
        if len(np.unique(y)) < 2:
            return pa.table({"shard": pa.array([], pa.int32()), "n": pa.array([], pa.int64()), "model": pa.array([], pa.binary())})
        row, flat, x = _flat(group)
        model = CumulativeLink.fit(row, flat, x, y)
        return pa.table({"shard": group.column("shard")[:1].combine_chunks(), "n": pa.array([len(y)], pa.int64()), "model": pa.array([np.concatenate([model.weights, model.cuts]).tobytes()], pa.binary())})

    models = stored(train.groupBy("shard").applyInArrow(fitted, "shard int, n long, model binary"), "ordinal-models")
    total, n = np.zeros(BUCKETS + GRADES - 1), 0
    for r in models.orderBy("shard").toLocalIterator():  # one model of fixed size at a time
        total, n = total + r.n * np.frombuffer(bytes(r.model)), n + r.n
    return (total[:BUCKETS] / n, total[BUCKETS:] / n) if n else None


def _flat(rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    index = [np.frombuffer(b, "<i4") for b in rows.column("i").to_pylist()]
    value = [np.frombuffer(b, "<f4") for b in rows.column("v").to_pylist()]
    return np.repeat(np.arange(len(index)), [len(i) for i in index]), np.concatenate(index).astype(np.int64), np.concatenate(value).astype(float)


def graded(docs: DataFrame, labels: DataFrame, shard_rows: int = SHARD_ROWS, lost: float = LOST) -> DataFrame:
    """``(doc_id, expected_grade, tail_probability, selected)`` for every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = stored(labelled_rows(labels, ["quality", "toxic"]), "ordinal-labels")
    shards = max(1, -(-known.count() // shard_rows))
    grade = F.when(F.col("quality") <= 0, 0).when(F.col("toxic") > 0, 1).otherwise(2)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch):
                found = list(hasher(part.column("text")))
                yield pa.record_batch(
                    [*(part.column(c) for c in ("doc_id", "shard", "grade")), pa.array([i.astype("<i4").tobytes() for i, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                    names=["doc_id", "shard", "grade", "i", "v"],
                )

    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")
    # Whole texts travel here: those of the held-out fold, which have no partner, stay. The join is the same at every size.
    labelled = rows.where(~held_out()).join(known.hint("merge"), "doc_id").select("doc_id", shard, grade.cast("int").alias("grade"), "text")
    train = stored(labelled.mapInArrow(features, _FEATURES), "ordinal-rows")
    shares = train.agg(F.count("*"), *[F.count_if(F.col("grade") <= k) for k in range(GRADES - 1)]).first()
    found = _averaged(train)
    if found:
        model = CumulativeLink(*found)

        def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    row, flat, x = _flat(batch)
                    z = np.bincount(row, x * model.weights[flat], minlength=batch.num_rows)
                    yield pa.record_batch([pa.array(np.zeros(batch.num_rows, np.int32)), pa.array(model.tails(z)[:, 0])], names=["one", "tail"])

        good = stored(train.where("grade > 0").mapInArrow(tails, "one int, tail double"), "ordinal-tails")
        threshold = min(0.5, ranked(good, ["one"], "tail", lambda n: F.floor((n - 1) * lost)).get((0,), 0.5))
    else:
        share = np.array([c / shares[0] if shares[0] else 1.0 for c in shares[1:]])
        share = np.clip(share, 1e-9, 1 - 1e-9)
        model, threshold = CumulativeLink(np.zeros(BUCKETS), np.log(share / (1 - share))), 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in slices(batch):
                z = np.array([float(model.weights[i] @ v) for i, v in hasher(part.column("text"))])
                tails = model.tails(z)
                yield pa.record_batch([part.column("doc_id"), pa.array(tails.sum(axis=1)), pa.array(tails[:, 0]), pa.array(tails[:, 0] >= threshold)], names=["doc_id", "expected_grade", "tail_probability", "selected"])

    return rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double, selected boolean")


def op10_ordinal(spark, sf_dir: str) -> DataFrame:
    found = graded(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out().alias("held_out"), "expected_grade", "tail_probability", "selected")
