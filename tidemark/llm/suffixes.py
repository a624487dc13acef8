"""Substring dedup by an enhanced suffix array and its tree of common-prefix intervals.

The suffixes of the whole corpus are compared in two steps. A sample of suffixes, the least of all 24-byte strings in each
window of 100 bytes, sorts windows into groups that share a long prefix around the same place (see ``repeats``); it is
chosen by content, so equal windows are sampled alike. The places that share a sampled suffix, but not their whole
context, are decided on an enhanced suffix array: suffixes in order with the common prefix of neighbours, scanned with
a stack into intervals. An interval of common prefix 100 or more holds all occurrences of a repeat, neighbours or not;
if its suffixes do not all follow the same byte the repeat is maximal, and all occurrences but the earliest are
removed. Tasks build the arrays for ranges of sampled suffixes. A sampled suffix with more than ``TOGETHER`` different
contexts is too much for one array: its windows are compared by hash instead, which spreads them.

Defined results: null, empty and short texts have no window and lose nothing; rows that share an id count as different
documents of which neither is earlier, so repeated rows of one id keep their text; a null id neither gives nor loses;
extra columns are ignored; an empty table gives an empty result. A task holds the text of one slice, or of one document
if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import BYTES, Rolling, mixed, table
from tidemark.llm.repeats import Scheme, remove_repeats, removed_units

WINDOW = 100
TOGETHER = 4096  # contexts of a sampled suffix that one array takes
ARRAY = 1 << 17  # suffixes of an array, about, unless one sampled suffix has more
SAMPLE = 24  # bytes of a sampled suffix that are looked at to choose it


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts side by side, and where each starts."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


class SuffixArray:
    """Suffixes at ``places`` of ``data``, in order of their first ``depth`` bytes, with common prefixes of neighbours.

    Suffixes are ordered by eight bytes at a time, and only those that still agree with another go on.
    """

    def __init__(self, data: np.ndarray, places: np.ndarray, depth: int, length: np.ndarray | None = None):
        """``length``: how long each suffix is, if it ends before ``depth`` bytes."""
        padded = np.concatenate([data, np.zeros(depth + 16, np.uint8)])
        eight = np.empty(len(data) + depth, np.uint64)  # the eight bytes from each place on
        for k in range(8):
            part = padded[k : k + (len(eight) - k + 7) // 8 * 8].view(">u8")
            eight[k::8] = part[: len(eight[k::8])]
        order, number = np.arange(len(places)), np.zeros(len(places), np.int64)
        head = np.zeros(len(places), bool)
        head[:1] = True
        for at in range(0, depth, 8):
            alone = head & np.append(head[1:], True)
            tied = np.flatnonzero(~alone)
            if not len(tied):
                break
            key = eight[places[order[tied]] + at]
            if depth - at < 8:
                key = key >> np.uint64(8 * (8 - depth + at))
            number[tied] = np.cumsum(head)[tied]
            sort = np.lexsort((key, number[tied]))
            order[tied] = order[tied[sort]]
            key = key[sort]
            differs = np.ones(len(tied), bool)
            differs[1:] = (key[1:] != key[:-1]) | (np.diff(tied) != 1)
            head[tied] |= differs
        self.data, self.order, self.places, self.depth = data, order, places[order], depth
        length = np.full(len(places), depth) if length is None else length[order]
        #: Common prefix of each suffix with the one before it in order.
        self.common = np.zeros(len(places), np.int64)
        view = np.lib.stride_tricks.sliding_window_view(padded, depth)
        for at in range(1, len(places), 1 << 15):
            stop = min(at + (1 << 15), len(places))
            differ = view[self.places[at:stop]] != view[self.places[at - 1 : stop - 1]]
            same = np.where(differ.any(axis=1), differ.argmax(axis=1), depth)
            self.common[at:stop] = np.minimum(same, np.minimum(length[at:stop], length[at - 1 : stop - 1]))

    def intervals(self, shortest: int, start: int = 0, stop: int | None = None) -> list[tuple[int, int, int]]:
        """``(prefix, first, last)`` of every interval of the tree whose common prefix is ``shortest`` bytes or more.

        Among the suffixes from ``start`` to before ``stop``, which must not share such a prefix with those around.
        """
        out, stack = [], []  # the stack holds (prefix, first) of open intervals
        common = [*self.common[start:stop].tolist(), 0]
        for i in range(1, len(common)):
            first = i - 1
            while stack and stack[-1][0] > common[i]:
                prefix, first = stack.pop()
                out.append((prefix, start + first, start + i - 1))
            if common[i] >= shortest and (not stack or stack[-1][0] < common[i]):
                stack.append((common[i], first))
        return out

    def diverse_intervals(self, shortest: int, left: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Prefix, first and last of the intervals whose suffixes do not all follow one byte, some at a time.

        ``left`` has the byte before each suffix in order, -1 where there is none. An interval without diversity is part
        of a longer repeat, whose interval starts one byte before.
        """
        # Whether left bytes differ within a stretch: some neighbour pair differs, or some byte is absent.
        change = np.zeros(len(left) + 1, np.int64)
        change[1:-1] = np.cumsum(left[1:] != left[:-1]) if len(left) > 1 else 0
        change[-1:] = change[-2:-1] if len(left) > 1 else 0
        absent = np.concatenate([[0], np.cumsum(left == -1)])
        # Intervals of two suffixes, by far the most, need no stack.
        deep = np.append(self.common >= shortest, False)
        deep[0] = False
        pairs = np.flatnonzero(deep[:-1] & ~np.concatenate([[False], deep[:-2]]) & ~deep[1:])
        rest = deep[:-1].copy()
        rest[pairs] = False
        found = [(self.common[pairs], pairs - 1, pairs)]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], rest.astype(np.int8), [0]]))).reshape(-1, 2)
        more = [x for a, b in edges for x in self.intervals(shortest, int(a) - 1, int(b))]
        if more:
            found.append(tuple(np.array(c, np.int64) for c in zip(*more)))
        for prefix, first, last in found:
            diverse = (change[last] > change[first]) | (absent[last + 1] > absent[first])
            if diverse.any():
                yield prefix[diverse], first[diverse], last[diverse]

    def maximal_repeats(self, shortest: int, left: np.ndarray | None = None) -> list[tuple[int, list[int]]]:
        """Length and all places of each repeat that no common byte extends to either side.

        ``left`` has the byte before each place as given, -1 where there is none.
        """
        if left is None:
            left = np.where(self.places > 0, self.data[np.maximum(self.places - 1, 0)].astype(np.int64), -1)
        else:
            left = left[self.order]
        return [
            (int(n), sorted(self.places[a : b + 1].tolist())) for found in self.diverse_intervals(shortest, left) for n, a, b in zip(*found)
        ]


class Suffixes(Scheme):
    window, same_document, slice_bytes, gap_bytes, together = WINDOW, True, 2 << 20, 37, TOGETHER
    kept_type = "binary"

    def units(self, texts):
        data, starts = _buffer(texts)
        return (lambda lane: BYTES[lane][data]), starts

    def anchors(self, units, starts, rolling: Rolling):
        w, q, n = self.window, SAMPLE, len(units)
        bounds = np.zeros(n + 1, np.int64)
        long = np.flatnonzero(np.diff(starts) >= w)
        np.add.at(bounds, starts[long], 1)
        np.add.at(bounds, starts[long + 1] - w + 1, -1)
        place = np.flatnonzero(np.cumsum(bounds)[:n] > 0)
        if not len(place):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        # Hashes of SAMPLE bytes; the least of each window by doubling, with its place in the low half.
        order = (rolling.sums[q:] - rolling.sums[:-q]) * rolling.inverse[: n - q + 1]
        order ^= order >> np.uint64(32)
        order *= np.uint64(0xBF58476D1CE4E5B9)
        order &= np.uint64(0xFFFFFFFF00000000)
        order |= np.arange(len(order), dtype=np.uint64)
        span, size = w - q + 1, 1
        while 2 * size <= span:
            order = np.minimum(order[:-size], order[size:])
            size *= 2
        if size < span:
            order = np.minimum(order[: len(order) - (span - size)], order[span - size :])
        anchor = (order[place] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        head = np.ones(len(place), bool)
        head[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(head)
        return place[at], np.diff(np.append(at, len(place))), mixed(rolling.of(anchor[at], anchor[at] + q))

    def cut_out(self, texts, first, stop):
        data, _ = _buffer(texts)
        whole = data.tobytes()
        return [whole[a:b] for a, b in zip(first.tolist(), stop.tolist())]

    def compare(self, contexts):
        """An enhanced suffix array for every few keys, whose contexts stay together."""
        order = np.argsort(contexts["key"], kind="stable")
        key, count = contexts["key"][order], contexts["count"][order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        before = np.cumsum(count) - count
        at = 0
        while at < len(heads):
            stop = max(at + 1, int(np.searchsorted(before[heads], before[heads[at]] + ARRAY)))
            part = order[heads[at] : heads[stop] if stop < len(heads) else len(order)]
            few = {c: v[part] if isinstance(v, np.ndarray) else [v[i] for i in part] for c, v in contexts.items()}
            for context, offset, length in self._compare(few):
                yield part[context], offset, length
            at = stop

    def _compare(self, contexts):
        """Intervals of an enhanced suffix array over contexts; every occurrence but the earliest is repeated."""
        w, count = self.window, contexts["count"]
        # What no text holds stands between contexts, so no common prefix goes on from one into the next.
        gap = b"\xff" * int(count.max())
        data = np.frombuffer(gap.join(contexts["units"]) + gap, np.uint8)
        size = count - 1 + w
        base = np.cumsum(size + len(gap)) - size - len(gap)
        owner = np.repeat(np.arange(len(count)), count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        array = SuffixArray(data, base[owner] + offset, w + len(gap) - 1, (size[owner] - offset))
        owner, offset = owner[array.order], offset[array.order]
        documents = np.unique(np.stack([contexts["slice"], contexts["row"]]), axis=1, return_inverse=True)[1].ravel()
        ids, document = contexts["id"][owner], documents[owner]
        place = contexts["place"][owner] + offset
        left = np.where(offset > 0, data[np.maximum(array.places - 1, 0)].astype(np.int64), -1)
        for prefix, first, last in array.diverse_intervals(w, left):
            # By interval: the smallest id, and in each document of that id the first place.
            sizes = last - first + 1
            group = np.repeat(np.arange(len(sizes)), sizes)
            at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            order = np.lexsort((place[at], document[at], ids[at], group))
            at, group = at[order], group[order]
            head = np.ones(len(at), bool)
            head[1:] = group[1:] != group[:-1]
            least = ids[at][head][np.cumsum(head) - 1]
            own_head = head.copy()
            own_head[1:] |= document[at][1:] != document[at][:-1]
            repeated = (ids[at] > least) | ~own_head
            yield owner[at][repeated], offset[at][repeated], prefix[group][repeated]

    def kept(self, texts, starts, removed):
        """The bytes left."""
        data, _ = _buffer(texts)
        out = []
        for a, b in zip(starts[:-1], starts[1:]):
            gone = removed[a:b]
            out.append((data[a:b][~gone] if gone.any() else data[a:b]).tobytes())
        return pa.array(out, pa.binary())


def op3_suffixes(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), Suffixes())
    return found.select(
        "doc_id", F.col("n_units").alias("n_bytes"), removed_units().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
