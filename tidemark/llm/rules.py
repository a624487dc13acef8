"""Rule statistics of documents, and an isolation forest over them.

Statistics are exact over whole texts. Forests split the shares that the rules look at (word length, signs, repeated
lines and words, capitals, exclamation marks) at random, one forest over all of them and one over each: documents that
few splits isolate are anomalies. Each forest has its own threshold, calibrated on labelled rows that pass the base
rules: beyond the scores of all but ``LOST`` of those with label 1, halfway to those of label 0 that it sets apart, or
beyond all label 1 rows if it sets none apart. All labelled rows outside the held-out fold are scored for the thresholds,
and each tree draws its rows from all of them.

Defined results: null, empty and wordless texts have zero statistics and fail the base rules; without labelled rows the
base rules alone decide; repeated rows are judged alike; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import slices, stored, table, words_of
from tidemark.llm.labelled import labelled_rows, ranked
from tidemark.operators.ordering import running_totals

TREES, PER_TREE = 60, 256
LOST = 0.0005
#: Share of the label 0 rows that a forest must set apart for its threshold to be drawn towards the others.
APART = 0.02
#: Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50

_COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_bangs")
_SHARES = ("word length", "signs", "repeated lines", "repeated words", "capitals", "exclamation marks")
_KIND = np.zeros(256, np.int64)
_KIND[list(b" \t\n\x0b\x0c\r")] = 1
_KIND[0x80:0xC0] = 2  # bytes that continue a character
_KIND[list(SYMBOLS)] = 3
_KIND[65:91] = 4
_KIND[97:123] = 5
_KIND[list(b"!")] = 6


def repeated_words(codes: np.ndarray, run: int = 3) -> int:
    """Words inside runs of ``run`` words that occur twice or more in the text."""
    if len(codes) <= run:
        return 0
    key = codes
    for k in range(1, run):  # pairs, then triples, named by rank: exact for any number of words
        names = np.unique(np.stack([key[: len(codes) - k], codes[k:]]), axis=1, return_inverse=True)[1] if codes.max() >= 1 << 21 else None
        key = names.ravel() if names is not None else (key[: len(codes) - k] << 21) | codes[k:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    starts = np.flatnonzero(again)
    covered = np.zeros(len(codes), bool)
    for k in range(run):
        covered[starts + k] = True
    return int(covered.sum())


def repeated_lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = part.column("text")
                _, codes, starts = words_of(texts)
                rows = np.zeros((part.num_rows, len(_COUNTED)), np.int64)
                for i, text in enumerate(texts.to_pylist()):
                    raw = (text or "").encode()
                    kind = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=7)
                    lines, again = repeated_lines(raw)
                    own = codes[starts[i] : starts[i + 1]]
                    rows[i] = (len(own), len(raw) - kind[1] - kind[2], kind[3], again, repeated_words(own), lines, kind[4], kind[4] + kind[5], kind[6])
                yield pa.record_batch([part.column("doc_id"), *[pa.array(c) for c in rows.T]], names=["doc_id", *_COUNTED])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTED))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _shares(batch) -> np.ndarray:
    get = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) if isinstance(batch, pa.RecordBatch) else batch.column(c).to_numpy().astype(float) for c in _COUNTED}
    words = np.maximum(get["n_words"], 1)
    return np.column_stack(
        [get["word_chars"] / words, get["n_symbols"] / words, get["n_dup_lines"] / np.maximum(get["n_lines"], 1), get["n_repeat_words"] / words, get["n_upper"] / np.maximum(get["n_letters"], 1), get["n_bangs"] / words]
    )


class Forest:
    """Isolation trees as flat arrays: a split's column and value, its two children, and the depth credited to a leaf."""

    def __init__(self, x: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 7, samples: list[np.ndarray] | None = None):
        """Each tree on ``per_tree`` of the rows ``x``; with ``samples`` on the row numbers it has drawn already."""
        rng = np.random.default_rng(seed)
        self.per_tree = min(per_tree, len(x)) if samples is None else len(samples[0])
        limit = int(np.ceil(np.log2(max(self.per_tree, 2))))
        self.trees = []
        for i in range(trees):
            nodes: list[tuple] = []
            self._grow(x[rng.choice(len(x), self.per_tree, replace=False) if samples is None else samples[i]], 0, limit, rng, nodes)
            self.trees.append(tuple(np.array(c) for c in zip(*nodes)))

    def _grow(self, x, depth, limit, rng, nodes) -> int:
        at = len(nodes)
        nodes.append(None)
        spread = np.flatnonzero(x.max(axis=0) > x.min(axis=0)) if len(x) else []
        if depth >= limit or len(x) <= 1 or not len(spread):
            nodes[at] = (-1, 0.0, at, at, depth + _path(len(x)))
            return at
        c = int(rng.choice(spread))
        value = float(rng.uniform(x[:, c].min(), x[:, c].max()))
        left = self._grow(x[x[:, c] < value], depth + 1, limit, rng, nodes)
        right = self._grow(x[x[:, c] >= value], depth + 1, limit, rng, nodes)
        nodes[at] = (c, value, left, right, 0.0)
        return at

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1; near 1 for what few splits isolate."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for column, value, left, right, credit in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = column[at] >= 0
                if not inner.any():
                    break
                below = x[rows, np.maximum(column[at], 0)] < value[at]
                at = np.where(inner, np.where(below, left[at], right[at]), at)
            total += credit[at]
        return 2.0 ** (-total / len(self.trees) / max(_path(self.per_tree), 1e-9))


def _path(n: int) -> float:
    """Mean depth of an unsuccessful search among ``n`` values."""
    return 0.0 if n <= 1 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n if n > 2 else 1.0


class Judge:
    """Forests over all shares and over each, with a threshold for each forest."""

    def __init__(self, forests: list[tuple[list[int], Forest]]):
        self.forests, self.thresholds = forests, [np.inf] * len(forests)

    def scores(self, x: np.ndarray) -> list[np.ndarray]:
        return [forest.score(x[:, columns]) for columns, forest in self.forests]

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of the forest over all shares, and whether any forest's threshold is passed."""
        scores = self.scores(x)
        return scores[0], np.any([s > t for s, t in zip(scores, self.thresholds)], axis=0)


_FORESTS = [list(range(len(_SHARES))), *[[c] for c in range(len(_SHARES))]]


def _forests(train: DataFrame, n: int) -> list[tuple[list[int], Forest]]:
    """Every tree draws its ``PER_TREE`` rows, the parameter of isolation forests, from all ``n`` rows; only those drawn reach the driver."""
    size = min(PER_TREE, n)
    drawn = [[np.random.default_rng([7, k, i]).choice(n, size, replace=False) for i in range(TREES)] for k in range(len(_FORESTS))]
    wanted = np.unique(np.concatenate([d for own in drawn for d in own]))
    below = running_totals(train.select("doc_id", F.lit(0).alias("one"), F.lit(1).alias("n")), ["one"], ["doc_id"], ["n"]).select("doc_id", "n_below")
    again = F.row_number().over(Window.partitionBy("doc_id").orderBy(*_COUNTED)) - 1
    placed = train.withColumn("again", again).join(below, "doc_id").withColumn("place", F.col("n_below") + F.col("again"))
    places = train.sparkSession.createDataFrame(pa.table({"place": wanted.astype(np.int64)}))
    rows = placed.join(F.broadcast(places), "place").select("place", *_COUNTED).orderBy("place").toArrow()
    x = _shares(rows)
    return [(columns, Forest(x[:, columns], seed=7 + k, samples=[np.searchsorted(wanted, d) for d in own])) for k, (columns, own) in enumerate(zip(_FORESTS, drawn))]


def _judge(train: DataFrame, lost: float) -> Judge | None:
    """Fitted on all rows of ``train``; thresholds are exact ranks among all of them."""
    n = train.count()
    if not n:
        return None
    judge = Judge(_forests(train, n))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                good = batch.column("quality").to_numpy(zero_copy_only=False) > 0
                for k, score in enumerate(judge.scores(_shares(batch))):
                    yield pa.record_batch([pa.array(np.full(len(good), k, np.int32)), pa.array(good), pa.array(score)], names=["forest", "good", "score"])

    scores = stored(train.mapInArrow(scored, "forest int, good boolean, score double"), "rule-scores")
    high = ranked(scores.where("good"), ["forest"], "score", lambda n: F.ceil((n - 1) * F.lit(1 - lost)))
    if not high:
        return judge
    cut = F.element_at(F.array(*[F.lit(high[(k,)]) for k in range(len(_FORESTS))]), F.col("forest") + 1)
    odd = scores.where(~F.col("good") & (F.col("score") > cut))
    first = ranked(odd, ["forest"], "score", lambda n: F.floor((n - 1) * F.lit(0.05)))
    second = ranked(odd, ["forest"], "score", lambda n: F.ceil((n - 1) * F.lit(0.05)))
    beyond = F.count_if(~F.col("good") & (F.col("score") > cut)).alias("beyond")
    for r in scores.groupBy("forest").agg(F.count_if(~F.col("good")).alias("bad"), beyond, F.max(F.when(F.col("good"), F.col("score"))).alias("most")).collect():
        if r.beyond > APART * max(1, r.bad):
            low, up = first[(r.forest,)], second[(r.forest,)]
            judge.thresholds[r.forest] = (high[(r.forest,)] + low + (up - low) * ((r.beyond - 1) * 0.05 % 1)) / 2
        else:
            judge.thresholds[r.forest] = r.most
    return judge


def quality(docs: DataFrame, labels: DataFrame, lost: float = LOST) -> DataFrame:
    """Statistics of each document with ``base_failed``, the ``anomaly`` score over all shares, and ``kept``."""
    stats = stored(statistics(docs), "rule-statistics").withColumn("base_failed", base_failed())
    judge = _judge(stored(stats.join(labelled_rows(labels, ["quality"]), "doc_id").where("not base_failed"), "rule-rows"), lost)
    names = [f.name for f in stats.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, odd = judge(_shares(batch)) if judge and batch.num_rows else (np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool))
            failed = batch.column("base_failed").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.record_batch([*batch.columns, pa.array(score), pa.array(~failed & ~odd)], names=[*names, "anomaly", "kept"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields)
    return stats.mapInArrow(run, schema + ", anomaly double, kept boolean")


def op8_rules(spark, sf_dir: str) -> DataFrame:
    found = quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
