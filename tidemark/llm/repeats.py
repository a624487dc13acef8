"""Which windows of a corpus also start earlier: the exchange behind both substring operators.

A scheme cuts every document into units (words, bytes) and names, for each window of a fixed number of units, an anchor
inside it that depends on the window's content alone, so equal windows have equal anchors. Windows next to each other
that share an anchor form a run; a run has the anchor's key and a hash of its context, all units its windows span.

1. Documents are written as slices (some MB of text each, compressed) with the runs of each slice: one entry for each
   distinct (key, context), dealt into buckets by key. Runs that a slice repeats are combined before they are shuffled.
2. Each bucket learns which contexts also occur in a smaller document, and which keys occur in several contexts.
3. Contexts of the first kind are repeated as a whole. Of the others with shared keys, the first occurrences are open:
   they give out their units, dealt into buckets by key, where the scheme compares them (``compare``). Contexts of a key
   with more than ``together`` of them, or all if the scheme does not compare, give out their windows one by one
   instead, as 96-bit hashes, combined inside the slice and dealt into buckets by hash: no key gathers.
4. Each bucket tells the slices which of the windows are repeated.
5. Each slice works out its documents' repeated windows from the answers and from itself.

A hot passage is one entry a slice, whatever number of documents hold it. Around its ends, though, each document may
give the same key another context; keys with more than ``scattered`` entries are found beforehand by counting, and
their entries are dealt by context instead of by key, so that no bucket holds more of a key than that, or than one entry
for each slice. The number of buckets follows the bytes of text, and entries spread over them by hash. Everything between the steps is
a written table in the shared folder or follows from such tables. A slice is read three times and its runs are worked out anew each time, which is
cheaper than to store them.

Documents that share an id count as different documents of which neither is smaller. A document without an id neither
gives nor loses a window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import Rolling, slices, stored

BUCKET_BYTES = 8 << 20  # of entries in a bucket, about
ENTRY_BYTES = 14
NAMELESS = np.iinfo(np.int64).max


class Runs:
    """Runs of windows in a slice: place of the first window, number of windows, key, context hash, document."""

    def __init__(self, first, count, key, context, document):
        self.first, self.count, self.key, self.context, self.document = first, count, key, context, document


class Scheme:
    """What an operator supplies. ``same_document``: whether an earlier start in the same document counts."""

    window: int
    same_document: bool
    slice_bytes: int
    gap_bytes: int  # of text for each run, about
    together: int = 0  # contexts of a key that are compared in one task
    scattered: int = 50_000  # entries of a key from which on they are dealt by context

    def units(self, texts: pa.Array) -> tuple[Callable[[int], np.ndarray], np.ndarray]:
        """A function that gives the units' 64-bit hashes of lane 0 or 1, and where each text's units start (n + 1 places)."""
        raise NotImplementedError

    def anchors(self, units: np.ndarray, starts: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per run of windows: the first window, the number of windows, the anchor's key."""
        raise NotImplementedError

    def cut_out(self, texts: pa.Array, first: np.ndarray, stop: np.ndarray) -> list[bytes]:
        """The units of contexts, as bytes."""
        raise NotImplementedError

    def compare(self, contexts: dict[str, np.ndarray | list]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Stretches that are repeated: context, offset in it and length. ``contexts`` has columns as ``_OPEN`` below."""
        raise NotImplementedError

    def kept(self, texts: pa.Array, starts: np.ndarray, removed: np.ndarray) -> pa.Array:
        """What is left of each text, given which units are removed."""
        raise NotImplementedError

    kept_type: str  # of ``kept``, for Spark


class Slice:
    """A slice's documents with their runs."""

    def __init__(self, scheme: Scheme, ids: pa.Array, texts: pa.Array):
        self.scheme, self.texts = scheme, texts
        self.ids = np.array([NAMELESS if x is None else x for x in ids.to_pylist()], np.int64)
        self.lane, self.starts = scheme.units(texts)
        units = self.lane(0)
        self.size = len(units)
        rolling = Rolling(units, 0)
        first, count, key = scheme.anchors(units, self.starts, rolling)
        document = np.searchsorted(self.starts, first, "right") - 1
        named = self.ids[document] != NAMELESS
        first, count, key, document = first[named], count[named], key[named], document[named]
        self.runs = Runs(first, count, key, rolling.of(first, first + count - 1 + scheme.window), document)
        self.rolling = rolling

    def entries(self) -> np.ndarray:
        """Indices of one run for each distinct (key, context): that of the smallest id, then the smallest place."""
        r = self.runs
        order = np.lexsort((r.first, self.ids[r.document], r.context, r.key))
        return order[_changes(r.key[order], r.context[order])]

    def windows(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, first hash and document of every window of the given runs."""
        r, w = self.runs, self.scheme.window
        count = r.count[runs]
        place = np.repeat(r.first[runs] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        return place, self.rolling.of(place, place + w), np.repeat(r.document[runs], count)

    def second_hash(self, place: np.ndarray) -> np.ndarray:
        return Rolling(self.lane(1), 1).of(place, place + self.scheme.window)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """True at the first row of each group of equal rows in sorted columns."""
    out = np.ones(len(columns[0]), bool)
    if len(out):
        out[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return out


def _bucket(a: np.ndarray, buckets: int) -> np.ndarray:
    return (((a >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _framed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=5).compress(sink.getvalue())


def _unframed(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(data)).read_all()


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x).tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


#: How entries store their two hashes. A bucket is a range of the first hash's upper half. Of a context's key the lower
#: half is enough beside it, as it only brings contexts together that are then compared by their own 64 bits; windows
#: are compared by 96 bits.
CONTEXTS, WINDOWS = ("<u4", "<u8"), ("<u8", "<u4")


def _dealt(number: int, a: np.ndarray, b: np.ndarray, ids: np.ndarray, buckets: int, kinds: tuple[str, str]) -> Iterator[tuple]:
    """Entries of one slice as rows ``(slice, bucket, a, b, ids)``; buckets are ranges of ``a``."""
    order = np.argsort(a, kind="stable")
    a, b, ids = a[order], b[order], ids[order]
    edges = np.searchsorted(_bucket(a, buckets), np.arange(buckets + 1))
    for k in np.flatnonzero(edges[1:] > edges[:-1]):
        part = slice(edges[k], edges[k + 1])
        yield number, int(k), a[part].astype(kinds[0]).tobytes(), b[part].astype(kinds[1]).tobytes(), _packed(ids[part])


_ENTRIES = "slice long, bucket int, a binary, b binary, ids binary"
_ENTRY_NAMES = ["slice", "bucket", "a", "b", "ids"]
_ENTRY_KINDS = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _rows(rows: list[tuple], names: list[str], kinds: list) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.Table.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def _gathered(group: pa.Table, kinds: tuple[str, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All entries of a bucket: a, b, ids and the slice of each."""
    a = [np.frombuffer(x, kinds[0]) for x in group.column("a").to_pylist()]
    b = [np.frombuffer(x, kinds[1]) for x in group.column("b").to_pylist()]
    ids = [_unpacked(x, np.int64) for x in group.column("ids").to_pylist()]
    numbers = np.repeat(np.array(group.column("slice").to_pylist(), np.int64), [len(x) for x in a])
    return np.concatenate(a), np.concatenate(b), np.concatenate(ids), numbers


#: Open contexts: where they are, how many windows they have, their document's row in the slice and its id, their units.
_OPEN = pa.schema([("key", pa.uint64()), ("place", pa.int64()), ("count", pa.int64()), ("row", pa.int64()), ("id", pa.int64()), ("units", pa.binary())])

_ANSWER = "slice long, a binary, first binary, open binary"
_ANSWER_KINDS = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _answers(numbers: np.ndarray, a: np.ndarray, first: np.ndarray, opened: np.ndarray) -> pa.Table:
    rows = []
    order = np.argsort(numbers, kind="stable")
    for part in np.split(order, np.flatnonzero(_changes(numbers[order]))[1:]) if len(order) else []:
        rows.append((int(numbers[part[0]]), a[part].tobytes(), _packed(first[part]), opened[part].tobytes()))
    return _rows(rows, ["slice", "a", "first", "open"], _ANSWER_KINDS)


def _context_answers(same_document: bool, together: int) -> Callable[[pa.Table], pa.Table]:
    def run(group: pa.Table) -> pa.Table:
        key, context, ids, numbers = _gathered(group, CONTEXTS)
        order = np.lexsort((ids, context, key))
        key, context, ids, numbers = key[order], context[order], ids[order], numbers[order]
        head = _changes(key, context)
        which = np.cumsum(head) - 1
        first = ids[head]  # by context
        key_head = _changes(key[head])
        key_of = np.cumsum(key_head) - 1
        contexts = np.bincount(key_of) if len(key_of) else np.zeros(0, np.int64)
        starts = np.flatnonzero(key_head)
        several = contexts > 1
        if not same_document and len(starts):
            several &= np.maximum.reduceat(first, starts) > np.minimum.reduceat(first, starts)
        how = np.where(several, np.where(contexts <= together, 1, 2), 0).astype(np.int8)
        opened = np.where(ids == first[which], how[key_of][which], np.int8(0)) if len(which) else np.zeros(0, np.int8)
        told = (opened > 0) | (ids > first[which])
        return _answers(numbers[told], context[told], first[which][told], opened[told])

    return run


def _window_answers(group: pa.Table) -> pa.Table:
    a, b, ids, numbers = _gathered(group, WINDOWS)
    order = np.lexsort((ids, b, a))
    a, b, ids, numbers = a[order], b[order], ids[order], numbers[order]
    head = _changes(a, b)
    first = ids[head][np.cumsum(head) - 1]
    told = ids > first
    return _answers(numbers[told], a[told], first[told], np.zeros(int(told.sum()), np.int8))


def _scattered_answers(group: pa.Table) -> pa.Table:
    """Of contexts of keys with very many: repeated ones, and first occurrences, which are to be judged window by window."""
    key, context, ids, numbers = _gathered(group, CONTEXTS)
    order = np.lexsort((ids, context, key))
    key, context, ids, numbers = key[order], context[order], ids[order], numbers[order]
    first = ids[_changes(key, context)][np.cumsum(_changes(key, context)) - 1]
    return _answers(numbers, context, first, np.where(ids == first, 2, 0).astype(np.int8))


def _hot_keys(entries: DataFrame, scattered: int) -> DataFrame:
    """``(bucket, hot)``: the keys of a bucket that have more than ``scattered`` entries, among those that any slice repeats."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for bucket, a in zip(batch.column("bucket").to_pylist(), batch.column("a").to_pylist()):
                key, n = np.unique(np.frombuffer(a, CONTEXTS[0]), return_counts=True)
                rows += [(bucket, int(k), int(m)) for k, m in zip(key[n > 1], n[n > 1])]
            yield from _rows(rows, ["bucket", "key", "n"], [pa.int32(), pa.int64(), pa.int64()]).to_batches()

    counts = entries.select("bucket", "a").mapInArrow(count, "bucket int, key long, n long").groupBy("bucket", "key").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") > scattered).groupBy("bucket").agg(F.collect_list("key").alias("hot"))


def _scatter(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries of hot keys leave their bucket for one that their context decides, beyond the ordinary buckets."""
    for batch in batches:
        rows = []
        for number, bucket, a, b, ids, hot in zip(*(batch.column(c).to_pylist() for c in [*_ENTRY_NAMES, "hot"])):
            if hot is None:
                rows.append((number, bucket, a, b, ids))
                continue
            key, context, own = np.frombuffer(a, CONTEXTS[0]), np.frombuffer(b, CONTEXTS[1]), _unpacked(ids, np.int64)
            moved = np.isin(key, np.array(hot, np.int64).astype(np.uint32))
            to = np.where(moved, buckets + _bucket(context, buckets), bucket)
            for k in np.unique(to):
                part = to == k
                rows.append((number, int(k), key[part].tobytes(), context[part].tobytes(), _packed(own[part])))
        yield from _rows(rows, _ENTRY_NAMES, _ENTRY_KINDS).to_batches()


def _read_slice(scheme: Scheme, table: pa.Table) -> Slice:
    rows = _unframed(table.column("body")[0].as_py())
    return Slice(scheme, *(rows.column(c).combine_chunks() for c in ("doc_id", "text")))


def _told(answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All answers to a slice, sorted by hash."""
    if not answers.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int8)
    a = np.concatenate([np.frombuffer(x, np.uint64) for x in answers.column("a").to_pylist()])
    first = np.concatenate([_unpacked(x, np.int64) for x in answers.column("first").to_pylist()])
    opened = np.concatenate([np.frombuffer(x, np.int8) for x in answers.column("open").to_pylist()])
    order = np.argsort(a, kind="stable")
    return a[order], first[order], opened[order]


def _lookup(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key is in ``sorted_keys``, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class _Judged:
    """A slice's runs after the first answers: repeated as a whole, or open (1: to be compared, 2: to be judged window by window)."""

    def __init__(self, own: Slice, answers: pa.Table):
        contexts, first, opened = _told(answers)
        r, ids = own.runs, own.ids[own.runs.document]
        at, known = _lookup(contexts, r.context)
        elsewhere = np.where(known, first[at] if len(first) else 0, NAMELESS)
        order = np.lexsort((r.first, r.document, ids, r.context, r.key))
        head = _changes(r.key[order], r.context[order])
        least = np.empty(len(ids), np.int64)
        least[order] = ids[order][head][np.cumsum(head) - 1] if len(order) else 0
        self.whole = ids > np.minimum(least, elsewhere)
        # The first run of a context in its own document.
        row_head = np.zeros(len(ids), bool)
        row_head[order] = _changes(r.key[order], r.context[order], r.document[order])
        if own.scheme.same_document:
            self.whole |= ~row_head
        self.open = np.where(known & ~self.whole & row_head, opened[at] if len(opened) else 0, 0)


def _slices(docs: DataFrame, scheme: Scheme, buckets: int) -> DataFrame:
    """Documents as slices (bucket -1) together with the entries of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, limit=scheme.slice_bytes):
                body = _framed(part)
                own = Slice(scheme, part.column("doc_id"), part.column("text"))
                chosen, r = own.entries(), own.runs
                rows = [(*x, None) for x in _dealt(number, r.key[chosen], r.context[chosen], own.ids[r.document[chosen]], buckets, CONTEXTS)]
                yield from _rows([*rows, (number, -1, None, None, None, body)], [*_ENTRY_NAMES, "body"], [*_ENTRY_KINDS, pa.binary()]).to_batches()
                number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _ENTRIES + ", body binary")


def _spans(starts: np.ndarray, removed: np.ndarray) -> pa.Array:
    """Per text the stretches of removed units, counted from its start."""
    edge = np.zeros(len(removed) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[False], removed])
    after = np.concatenate([removed, [False]])
    begin = np.flatnonzero(after & (~before | edge))
    stop = np.flatnonzero(before & (~after | edge))
    text = np.searchsorted(starts, begin, "right") - 1
    pairs = pa.StructArray.from_arrays([pa.array(begin - starts[text]), pa.array(stop - starts[text])], ["start", "stop"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(starts))), pa.int32()), pairs)


def remove_repeats(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """Every document without its repeated windows.

    Columns: ``doc_id``, ``n_units``, the removed ``spans`` (start, stop) in units, and what is ``kept``.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    buckets = max(8, size // scheme.gap_bytes * ENTRY_BYTES // BUCKET_BYTES)
    written = stored(_slices(docs, scheme, buckets), "slices")
    entries = written.where("bucket >= 0").select(*_ENTRY_NAMES)
    bodies = written.where("bucket = -1").select("slice", "body")
    hot = stored(_hot_keys(entries, scheme.scattered), "hot-keys")
    if not hot.isEmpty():
        entries = entries.join(hot, "bucket", "left").mapInArrow(lambda batches: _scatter(batches, buckets), _ENTRIES)
    by_key = _context_answers(scheme.same_document, scheme.together)

    def answer(group: pa.Table) -> pa.Table:
        return by_key(group) if group.column("bucket")[0].as_py() < buckets else _scattered_answers(group)

    contexts = stored(entries.groupBy("bucket").applyInArrow(answer, _ANSWER), "context-answers")

    given_names, given_kinds = [*_ENTRY_NAMES, "open"], [*_ENTRY_KINDS, pa.binary()]

    def give_out(body: pa.Table, answers: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if body.num_rows:
            number, own = body.column("slice")[0].as_py(), _read_slice(scheme, body)
            how, r = _Judged(own, answers).open, own.runs
            place, a, document = own.windows(np.flatnonzero(how == 2))
            order = np.lexsort((own.ids[document], a))
            one = order[_changes(a[order])]
            b = own.second_hash(place[one]) if len(one) else a
            rows = [(*x, None) for x in _dealt(number, a[one], b, own.ids[document[one]], buckets, WINDOWS)]
            chosen = np.flatnonzero(how == 1)
            chosen = chosen[np.argsort(r.key[chosen], kind="stable")]
            bucket = _bucket(r.key[chosen], buckets)
            for part in np.split(chosen, np.flatnonzero(_changes(bucket))[1:]) if len(chosen) else []:
                units = scheme.cut_out(own.texts, r.first[part], r.first[part] + r.count[part] - 1 + scheme.window)
                columns = [r.key[part], r.first[part], r.count[part], r.document[part], own.ids[r.document[part]], pa.array(units, pa.binary())]
                rows.append((number, int(_bucket(r.key[part[:1]], buckets)[0]), None, None, None, _framed(pa.record_batch([pa.array(c) for c in columns], schema=_OPEN))))
        return _rows(rows, given_names, given_kinds)

    def compare(group: pa.Table) -> pa.Table:
        numbers = group.column("slice").to_pylist()
        parts = [_unframed(x) for x in group.column("open").to_pylist()]
        whole = pa.concat_tables(parts)
        columns = {c: whole.column(c).to_numpy() if c != "units" else whole.column(c).to_pylist() for c in _OPEN.names}
        columns["slice"] = np.repeat(np.array(numbers, np.int64), [p.num_rows for p in parts])
        found = list(scheme.compare(columns)) if whole.num_rows else []
        rows = []
        if found:
            context, offset, length = (np.concatenate(c) for c in zip(*found))
            first, of = columns["place"][context] + offset, columns["slice"][context]
            order = np.argsort(of, kind="stable")
            for part in np.split(order, np.flatnonzero(_changes(of[order]))[1:]):
                rows.append((int(of[part[0]]), _packed(first[part]), _packed(length[part])))
        return _rows(rows, ["slice", "first", "length"], [pa.int64(), pa.binary(), pa.binary()])

    given = bodies.join(contexts.select("slice").distinct(), "slice", "left_semi").groupBy("slice").cogroup(contexts.groupBy("slice"))
    given = stored(given.applyInArrow(give_out, _ENTRIES + ", open binary"), "open-contexts")
    windows = given.where("open is null").select(*_ENTRY_NAMES).groupBy("bucket").applyInArrow(_window_answers, _ANSWER)
    stretches = given.where("open is not null").select("slice", "bucket", "open").groupBy("bucket").applyInArrow(compare, "slice long, first binary, length binary")
    answers = (
        contexts.withColumn("kind", F.lit(0))
        .unionByName(windows.withColumn("kind", F.lit(1)))
        .unionByName(stretches.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    )

    names = ["doc_id", "n_units", "spans", "kept"]
    result = f"doc_id long, n_units long, spans array<struct<start: long, stop: long>>, kept {scheme.kept_type}"

    def finish(body: pa.Table, answers: pa.Table) -> pa.Table:
        own = _read_slice(scheme, body)
        kind = answers.column("kind").to_numpy()
        told = [answers.filter(pa.array(kind == k)) for k in range(3)]
        judged = _Judged(own, told[0])
        r, w = own.runs, scheme.window
        covered = np.zeros(own.size + 1, np.int32)
        whole = np.flatnonzero(judged.whole)
        np.add.at(covered, r.first[whole], 1)
        np.add.at(covered, r.first[whole] + r.count[whole] - 1 + w, -1)
        for first, length in zip(told[2].column("first").to_pylist(), told[2].column("length").to_pylist()):
            first, length = _unpacked(first, np.int64), _unpacked(length, np.int64)
            np.add.at(covered, first, 1)
            np.add.at(covered, first + length, -1)
        place, a, document = own.windows(np.flatnonzero(judged.open == 2))
        if len(place):
            known = _lookup(_told(told[1])[0], a)[1]
            group, ids = np.unique(a, return_inverse=True)[1], own.ids[document]
            least = np.full(int(group.max()) + 1, NAMELESS)
            np.minimum.at(least, group, ids)
            repeated = known | (ids > least[group])
            if scheme.same_document:
                order = np.lexsort((place, document, group))
                later = np.zeros(len(place), bool)
                later[order] = ~_changes(group[order], document[order])
                repeated |= later
            np.add.at(covered, place[repeated], 1)
            np.add.at(covered, place[repeated] + w, -1)
        removed = np.cumsum(covered)[:-1] > 0
        ids = pa.array([None if x == NAMELESS else int(x) for x in own.ids.tolist()], pa.int64())
        return pa.Table.from_arrays([ids, pa.array(np.diff(own.starts)), _spans(own.starts, removed), scheme.kept(own.texts, own.starts, removed)], names=names)

    return bodies.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(finish, result)


def removed_units() -> Column:
    return F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"]), F.lit(0).cast("long"))
