from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, place long, lane string, stripe string, slot string, score string"


def vectors(dim=4, n=300, labels=3, spread=1.0, seed=1):
    r = random.Random(seed)
    return [(i, [round(r.gauss(0.3, spread) * 8) / 8 for _ in range(dim)], r.randrange(labels)) for i in range(n)]


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*x, 7, "x", "y", "z", "s") for x in rows], SCHEMA).repartition(parts)


def brute(rows, every, positives=5, negatives_=3, low=50, high=95):
    whole = lambda x: math.floor(x * 256) if abs(x) < 1e300 else int(x) * 256
    rows = [(i, [whole(x) for x in v], c) for i, v, c in rows if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, va, ca in rows:
        if a % every:
            continue
        scored = [(-max(-(1 << 56), min(1 << 56, sum(x * y for x, y in zip(va, v)))), i, c) for i, v, c in rows if i != a]
        for s, p, _ in sorted((s, i, c) for s, i, c in scored if c == ca)[:positives]:
            inside = sorted((t, i) for t, i, c in scored if c != ca and low * -s <= 100 * -t <= high * -s)
            out += [(a, p, k + 1, i, -s, -t) for k, (t, i) in enumerate(inside[:negatives_])]
    return sorted(out)


def found(spark, rows, every, **options):
    got = negatives.hard_negatives(frame(spark, rows), F.col("vec_id") % every == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize(
    "rows",
    [
        vectors(),
        vectors(dim=2, spread=0.2),  # many ties
        [(i, v, c if i % 3 else 0) for i, v, c in vectors(dim=3, labels=9)],  # a hot label
        [(i, [0.5, 0.25] if i % 3 else v, c) for i, v, c in vectors(dim=2)],  # a hot vector
        [(i, [x * 3e5 for x in v], c) for i, v, c in vectors()],  # too large for exact doubles
        [(i, [x * (3e37 if i % 5 else 1.0) for x in v], c) for i, v, c in vectors(n=80)],  # scores beyond 2^56
    ],
)
def test_against_brute_force(spark, rows):
    want = brute(rows, 7)
    assert found(spark, rows, 7) == want
    assert want or max(abs(x) for _, v, _ in rows for x in v) > 1e30
    other = dict(positives=2, negatives=6, low=10, high=80)
    assert found(spark, rows, 7, **other) == brute(rows, 7, 2, 6, 10, 80)


def test_many_lanes_and_stripes(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 37)
    monkeypatch.setattr(negatives, "SCORES", 64)
    rows = vectors(n=500)
    assert found(spark, rows, 3) == brute(rows, 3)


def test_odd_rows(spark):
    rows = vectors(n=60) + [(None, [1.0] * 4, 1), (100, None, 1), (101, [1.0, None, 1.0, 1.0], 1), (102, [float("nan")] * 4, 1), (105, [float("inf")] * 4, 1)]
    rows += [(112, [0.5, 0.5], 1), (119, [], 2), (126, [0.25] * 6, 0), (130, [0.5] * 4, None), (-7, [0.5] * 4, 1)]
    rows += [(14, [0.5, 0.5, 0.25, 0.5], 1), (15, [0.5, 0.5, 0.25, 0.5], 2), (15, [0.5, 0.5, 0.25, 0.5], 2)]  # repeated ids
    assert found(spark, rows, 7) == brute(rows, 7)


def test_few_rows(spark):
    for rows in ([], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1), (2, [0.75], 2)], [(0, [-1.0], 1), (1, [1.0], 1), (2, [0.75], 2)]):
        assert found(spark, rows, 7) == brute(rows, 7)


def test_query_moves_labels(spark, tmp_path):
    rows = vectors(n=400, labels=10, dim=6)
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted(tuple(r) for r in negatives.op11_negatives(spark, str(tmp_path)).collect())
    assert got == brute([(i, v, c if i % 7 else (c + 1) % 10) for i, v, c in rows], 50)
