from __future__ import annotations

import random
import zlib
from fractions import Fraction

import cases
import pytest

from tidemark.llm import periodic


def runs_of(w: list[str], shortest=24, periods=3) -> list[tuple[int, int, int]]:
    """Every stretch that keeps a period and cannot be extended, by its smallest period."""
    out = []
    for q in range(1, len(w) // periods + 1):
        start = 0
        for i in range(len(w) - q + 1):
            if i == len(w) - q or w[i] != w[i + q]:
                length = i - start + q
                own = w[start : start + length]
                if i > start and length >= max(shortest, periods * q) and not any(own[d:] == own[:-d] for d in range(1, q)):
                    out.append((start, length, q))
                start = i + 1
    return sorted(out)


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def texts() -> list[str | None]:
    r = random.Random(2)
    out = [None, "", " \n ", "a " * 23, "a " * 24, "a b " * 200, "x " + "a b c " * 8 + "a", "a b c d e f g h i " * 2 + "a b c d e f", "  é " * 30]
    for _ in range(120):
        letters, w = "abcd"[: r.randrange(1, 5)], []
        for _ in range(r.randrange(1, 9)):
            block = [r.choice(letters) for _ in range(r.randrange(1, 25))]
            w += (block * r.randrange(1, 7))[: r.randrange(1, 120)] + w[-r.randrange(1, 30) :] * r.randrange(2)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("shortest", "periods"), [(24, 3), (5, 3), (9, 4)])
def test_runs_and_collapsed_texts(spark, shortest, periods):
    rows = [(i // 2, t, "en", "src", 0) for i, t in enumerate(texts())] + [(None, "a " * 30, "en", "src", 0)]
    got = periodic.periodic_runs(cases.frame(spark, rows), shortest, periods)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    want = []
    for d, t, *_ in rows:
        w = cases.words(t)
        runs = runs_of(w, shortest, periods)
        want.append((d, len(w), runs, collapsed(w, runs)))
    assert got == sorted(want, key=str)
    assert sum(len(x[2]) for x in want) > 50


def test_query(spark, tmp_path):
    rows = [(i, t, "en", "src", 0) for i, t in enumerate(texts() * 2)] + [x for x in cases.documents() if len(cases.words(x[1])) < 900]
    cases.frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in periodic.op12_runs(spark, str(tmp_path)).collect()), key=str)
    want, moved = [], 0
    for d, t, *_ in rows:
        w = cases.words(t)
        h = 1 if d is None else zlib.crc32(str(d).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w, moved = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))], moved + 1
        runs = runs_of(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((d, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], cases.sha(lines.encode()), cases.sha(collapsed(w, runs).encode())))
    assert got == sorted(want, key=str) and moved > 10


def test_long_texts_take_linear_time():
    import time

    import numpy as np

    r = random.Random(4)
    start = time.perf_counter()
    for w in (["a"] * 300_000, [str(r.randrange(9999)) for _ in range(60_000)] * 5, sum(([*"abcdefghijklmnopqrst", str(r.randrange(9999))] for _ in range(10_000)), [])):
        units = np.append(len(w), np.unique(w, return_inverse=True)[1])
        found = periodic.maximal_pairs(units, 24, 3)
        assert len(found) == (w[0] != "a" or w[1] == "a")
    assert time.perf_counter() - start < 30


def test_a_period_must_be_held_three_times(spark):
    with pytest.raises(ValueError):
        periodic.periodic_runs(cases.frame(spark, []), periods=2)


def test_empty_table(spark):
    assert periodic.periodic_runs(cases.frame(spark, [])).count() == 0
