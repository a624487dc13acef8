"""Substring dedup by recompression.

Rounds of recompression name runs of equal tokens and pairs of adjacent tokens, over and over. Names are hashes of what
they stand for and the split of names into left and right halves is a bit of the name, so both are the same on every
task without any exchange: equal substrings get equal symbols inside, and differ at most near their ends. Each symbol
carries how far its making looked to both sides. Symbols whose look lies inside a window are the window's own
whatever surrounds it, so the window's anchor is the least of the highest-level ones. Shared symbols reveal repeats;
hashes of the whole context and of single windows verify them (see ``repeats``). Windows that are too periodic to own
a symbol of some level stand for themselves.

Defined results: null, empty and short texts have no window and lose nothing; repeated rows lose their words to a
smaller doc_id only, so rows of one id keep theirs; a null id neither gives nor loses; extra columns are ignored; an
empty table gives an empty result. A task holds the text of one slice, or of one document if that is longer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import Rolling, mixed, table, word_hashes, words_of
from tidemark.llm.repeats import Scheme, remove_repeats, removed_units

WINDOW = 50
#: Steps of recompression: "runs" or a round of "pairs"; windows take anchors from the levels after these steps, best first.
STEPS = ("runs", "pairs", "pairs", "pairs", "runs", "pairs", "pairs", "pairs")
LEVELS = (7, 5, 3, 2)


class Symbols:
    """Symbols of one level: name, stretch of tokens, and the tokens that their making looked at."""

    def __init__(self, name, lo, hi, document):
        self.name, self.lo, self.hi, self.document = name, lo, hi, document


def _neighbours(s: Symbols, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far each symbol's left and right neighbour looked; beyond the document's ends where there is none."""
    left = np.empty_like(s.lo)
    right = np.empty_like(s.hi)
    left[1:], right[:-1] = s.lo[:-1], s.hi[1:]
    first = np.ones(len(left), bool)
    first[1:] = s.document[1:] != s.document[:-1]
    last = np.append(first[1:], True)
    left[first] = starts[s.document[first]] - 1
    right[last] = starts[s.document[last] + 1] + 1
    return left, right


def name_runs(s: Symbols, starts: np.ndarray) -> Symbols:
    left, right = _neighbours(s, starts)
    head = np.ones(len(s.name), bool)
    head[1:] = (s.name[1:] != s.name[:-1]) | (s.document[1:] != s.document[:-1])
    at = np.flatnonzero(head)
    last = np.append(at[1:], len(head)) - 1
    count = (last - at + 1).astype(np.uint64)
    name = np.where(count > 1, mixed(s.name[at] ^ mixed(count)), s.name[at])
    return Symbols(name, left[at], right[last], s.document[at])


def name_pairs(s: Symbols, starts: np.ndarray, step: int) -> Symbols:
    left, right = _neighbours(s, starts)
    is_left = (mixed(s.name + np.uint64(step + 1)) >> np.uint64(63)).astype(bool)
    joins = np.zeros(len(s.name), bool)  # with the next one
    joins[:-1] = is_left[:-1] & ~is_left[1:] & (s.document[1:] == s.document[:-1])
    second = np.zeros(len(joins), bool)
    second[1:] = joins[:-1]
    lo = np.where(is_left, s.lo, left)  # a right symbol looked whether it has a left one before it
    hi = np.where(is_left, right, s.hi)
    at = np.flatnonzero(~second)
    pair = joins[at]
    mate = np.minimum(at + 1, len(joins) - 1)
    name = np.where(pair, mixed(mixed(s.name[at]) + s.name[mate] * np.uint64(3)), s.name[at])
    return Symbols(name, np.where(pair, s.lo[at], lo[at]), np.where(pair, s.hi[mate], hi[at]), s.document[at])


def levels(units: np.ndarray, starts: np.ndarray) -> list[Symbols]:
    """The symbols after each step, the plain tokens first."""
    at = np.arange(len(units))
    s = Symbols(units, at, at + 1, np.searchsorted(starts, at, "right") - 1)
    out = [s]
    for step, kind in enumerate(STEPS):
        s = name_runs(s, starts) if kind == "runs" else name_pairs(s, starts, step)
        out.append(s)
    return out


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Smallest of ``values`` in each nonempty range, by a table of powers of two."""
    size = end - begin
    power = np.frexp(size.astype(float))[1] - 1
    out = np.empty(len(begin), np.uint64)
    rows = values
    for p in range(int(power.max()) + 1 if len(power) else 0):
        own = power == p
        out[own] = np.minimum(rows[begin[own]], rows[end[own] - (1 << p)])
        if len(rows) > 1 << p:
            rows = np.minimum(rows[: -(1 << p)], rows[1 << p :])
    return out


class Recompression(Scheme):
    window, same_document, slice_bytes, gap_bytes = WINDOW, False, 4 << 20, 70
    kept_type = "string"

    def units(self, texts):
        words, codes, starts = words_of(texts)

        def lane(k: int) -> np.ndarray:
            return word_hashes(words, k)[codes] if len(words) else np.zeros(0, np.uint64)

        return lane, starts

    def anchors(self, units, starts, rolling: Rolling):
        w = self.window
        n = len(units)
        valid = np.zeros(n, bool)
        bounds = np.zeros(n + 1, np.int64)
        long = np.flatnonzero(np.diff(starts) >= w)
        np.add.at(bounds, starts[long], 1)
        np.add.at(bounds, starts[long + 1] - w + 1, -1)
        valid = np.cumsum(bounds)[:n] > 0
        place = np.flatnonzero(valid)
        if not len(place):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        anchor = np.full(len(place), -1, np.int64)
        keys: list[np.ndarray] = []
        offset = 0
        made = levels(units, starts)
        for level in LEVELS:
            s = made[level + 1]
            left = np.flatnonzero(anchor < 0)
            # Symbols whose look starts at the window's start or later, and ends in it.
            begin = np.cumsum(np.bincount(np.maximum(s.lo + 1, 0), minlength=n + 2))[place[left]]
            end = np.cumsum(np.bincount(np.minimum(s.hi, n + 1), minlength=n + 2))[place[left] + w]
            some = end > begin
            order = (mixed(s.name ^ np.uint64(0xA5A5)) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(s.name)).astype(np.uint64)
            best = (_least(order, begin[some], end[some]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            anchor[left[some]] = offset + best
            lo, hi = np.clip(s.lo, 0, n), np.clip(s.hi, 0, n)
            keys.append(mixed(rolling.of(lo, np.maximum(hi, lo)) + np.uint64(level)))
            offset += len(s.name)
        alone = anchor < 0
        anchor[alone] = offset + np.arange(int(alone.sum()))
        keys.append(rolling.of(place[alone], place[alone] + w))
        head = np.ones(len(place), bool)
        head[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(head)
        return place[at], np.diff(np.append(at, len(place))), np.concatenate(keys)[anchor[at]]

    def kept(self, texts, starts, removed):
        """The words left, joined by single spaces."""
        out = []
        for i, text in enumerate(texts.to_pylist()):
            words, gone = (text or "").encode().split(), removed[starts[i] : starts[i + 1]]
            if gone.any():
                words = [x for x, lost in zip(words, gone.tolist()) if not lost]
            out.append(b" ".join(words))
        return pa.array(out, pa.string())


def op1_recompression(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), Recompression())
    return found.select("doc_id", F.col("n_units").alias("n_words"), removed_units().alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
