"""Both substring operators against brute force, and the parts that they are made of."""

from __future__ import annotations

import random

import cases
import numpy as np
import pytest

from tidemark.llm import recompression, suffixes
from tidemark.llm.repeats import remove_repeats


@pytest.mark.parametrize("parts, slice_bytes, together, scattered", [(1, None, 4096, 50_000), (6, 2000, 4096, 50_000), (6, 2000, 3, 50_000), (3, 5000, 0, 4), (3, 9000, 4096, 2)])
@pytest.mark.parametrize("scheme, brute", [(recompression.Recompression, cases.kept_words), (suffixes.Suffixes, cases.kept_bytes)])
def test_against_brute_force(spark, scheme, brute, parts, slice_bytes, together, scattered):
    own = scheme()
    own.together, own.scattered = min(own.together, together), scattered
    own.slice_bytes = slice_bytes or own.slice_bytes
    got = []
    for r in remove_repeats(cases.frame(spark, parts=parts), own).collect():
        spans, kept = [tuple(s) for s in r.spans], r.kept if isinstance(r.kept, str) else bytes(r.kept)
        assert all(a < b for a, b in spans) and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))
        lost = sum(b - a for a, b in spans)
        n_spans = [len(spans)] * (scheme is suffixes.Suffixes)
        got.append((r.doc_id, r.n_units, lost, *n_spans, cases.sha(kept.encode() if isinstance(kept, str) else kept)))
    assert sorted(got, key=str) == brute(cases.documents())


@pytest.mark.parametrize("scheme", [recompression.Recompression, suffixes.Suffixes])
def test_empty_table(spark, scheme):
    assert remove_repeats(cases.frame(spark, []), scheme()).count() == 0


def test_equal_substrings_get_equal_symbols():
    r = np.random.default_rng(3)
    shared = r.integers(0, 50, 60).astype(np.uint64)
    sides = [r.integers(0, 50, 40).astype(np.uint64) for _ in range(4)]
    units = np.concatenate([sides[0], shared, sides[1], sides[2], shared, sides[3]])
    starts = np.array([0, 140, 280])
    for level in recompression.levels(units, starts):
        inside = []
        for base in (40, 180):
            own = (level.lo >= base) & (level.hi <= base + 60)
            inside.append(list(zip(level.lo[own] - base, level.hi[own] - base, level.name[own])))
        assert inside[0] == inside[1]
    assert inside[0]


def test_maximal_repeats():
    r = random.Random(1)
    data = bytes(r.choice(b"ab") for _ in range(120))
    array = suffixes.SuffixArray(np.frombuffer(data, np.uint8), np.arange(len(data) - 11), 12)
    got = {(n, tuple(p)) for n, p in array.maximal_repeats(5) if n < 12}
    want = set()
    for n in range(5, 12):
        places = {}
        for s in range(len(data) - 11):
            places.setdefault(data[s : s + n], []).append(s)
        for p in places.values():
            left = {data[s - 1] if s else -1 for s in p}
            right = {data[s + n] for s in p}
            if len(p) > 1 and len(right) > 1 and (len(left) > 1 or -1 in left):
                want.add((n, tuple(p)))
    assert got == want
