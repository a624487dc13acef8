from __future__ import annotations

import cases
import numpy as np
import pytest

from tidemark.llm import simhash
from tidemark.llm.common import components


def test_against_brute_force(spark):
    rows = cases.documents()
    got = simhash.near_duplicates(cases.frame(spark)).collect()
    fps = {t: cases.fingerprint(t) for _, t, *_ in rows}
    distinct = sorted(set(fps.values()))
    group = dict(zip(distinct, cases.linked(distinct)))
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            g = group[fps[t]]
            least[g] = min(least.get(g, d), d)
    want = sorted(((d, fps[t], least.get(group[fps[t]])) for d, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got), key=str) == want


@pytest.mark.parametrize("fanout", [2048, 16])
def test_links_of_a_dense_family(spark, monkeypatch, fanout):
    """Many fingerprints a few bits apart: every component is found, with no more links than a forest needs in each unit."""
    monkeypatch.setattr(simhash, "FANOUT", fanout)
    r = np.random.default_rng(2)
    centres = r.integers(0, 1 << 63, 3, dtype=np.uint64)
    values = {int(c) ^ sum(1 << int(b) for b in r.choice(64, k, replace=False)) for c in centres for k in (0, 1, 2, 4, 5) for _ in range(40)}
    values |= {int(x) for x in r.integers(0, 1 << 63, 200, dtype=np.uint64)} | {0}
    values = sorted(values)
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    edges = simhash.fingerprint_links(df)
    pairs = [(a & (1 << 64) - 1, b & (1 << 64) - 1) for a, b in edges.collect()]
    group = dict(zip(values, cases.linked(values)))
    assert all(group[a] == group[b] for a, b in pairs)
    roots = {r.node & (1 << 64) - 1: r.root for r in components(edges).collect()}
    found = {}
    for v in values:
        found.setdefault(roots.get(v, ("alone", v)), set()).add(v)
    want = {}
    for v in values:
        want.setdefault(group[v], set()).add(v)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 102: 100}


def test_thresholds_cover_the_distance():
    law = np.full((8, 9), 1 / 9)
    for n in (10, 10**6, 10**10):
        chosen = simhash.plan(n, law, 3)
        assert sum(t + 1 for _, t in chosen) > 3 and sorted(b for part, _ in chosen for b in part) == list(range(8))


def test_one_document_of_each_group_stays(spark):
    df = cases.frame(spark)
    left = simhash.without_duplicates(df)
    assert left.columns == df.columns
    fps = [cases.fingerprint(r.text) for r in left.collect()]
    assert cases.linked(fps) == list(range(len(fps)))
    assert len(fps) == len(set(cases.linked(sorted({cases.fingerprint(t) for _, t, *_ in cases.documents()}))))


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.frame(spark, [])).count() == 0


def test_kept_documents_carry_any_columns(spark):
    """Columns named like the operator's own come back as they were."""
    df = spark.createDataFrame([(1, "a b c d", 7, "x"), (2, "a b c d", 8, "y"), (3, None, 9, "z")], "doc_id long, text string, kept_key int, kept_place string")
    got = simhash.without_duplicates(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect())) == [(1, "a b c d", 7, "x"), (3, None, 9, "z")]
