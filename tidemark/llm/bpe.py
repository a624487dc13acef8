"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than ``CHUNK`` characters is cut into chunks that overlap, which are dealt over the cluster and pre-tokenised
each for itself. A chunk starts at an arbitrary place, so its first pre-tokens may be wrong; but where one of its boundaries
is also a boundary of the chunk before, both go on alike from there, as a match depends only on what follows its start.
The first such place in the overlap is where two chunks are stitched. Chunks without one (a run of letters may cover
the overlap) are merged and pre-tokenised again, until all neighbours are stitched. The pieces between stitches are then
encoded in parallel, each pre-token by the merge ranks, and a document's ids put in order. Decoding concatenates the raw
bytes of the ids. Texts of up to ``CHUNK`` characters are one chunk with nothing to stitch.

A chunk's boundaries count only if the match before ends ``MARGIN`` characters before the chunk does, as the pattern may
look further; a pattern that looks back, or more than ``MARGIN`` ahead behind its match, is not supported. The classes of
characters in the pattern are those of the library that defines the encoding, asked once for each process.

Defined results: null and empty texts have no ids; repeated rows, repeated and null ids are rows of their own; extra columns are
ignored or, where asked for, kept; an empty table gives an empty result; ids outside the vocabulary cannot be decoded
and are an error.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tidemark.llm.common import slices, stored, table

CHUNK = 16_384  # characters
OVERLAP = 256
MARGIN = 16
#: Distinct pre-tokens whose ids a task remembers; beyond it starts afresh. A matter of speed only.
REMEMBERED = 150_000
DECODED = 500_000  # ids at a time


@functools.cache
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


# --- pre-tokens -------------------------------------------------------------------------------------------------------


def _members(klass: str) -> list[tuple[int, int]]:
    """The code points of a class such as ``\\s`` as ranges, by the library itself."""
    import tiktoken

    probe = tiktoken.Encoding("probe", pat_str=klass, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    text = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    found = np.frombuffer(bytes(probe.encode_ordinary(text)).decode().encode("utf-32-le"), "<u4").astype(np.int64)
    edges = np.flatnonzero(np.diff(found) != 1)
    return list(zip(found[np.append(0, edges + 1)].tolist(), found[np.append(edges, len(found) - 1)].tolist()))


#: A splitter with a limit serves texts of lower code points only; the lower the limit, the shorter its classes.
LIMITS = (0x80, 0x10000, 0x110000)


@functools.cache
def splitters(pattern: str) -> tuple[str, ...]:
    """``pattern`` with its classes written out, one for each of ``LIMITS``. Asked for once, on the driver."""
    tokens = re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.S)
    known = {t: _members(t) for t in set(tokens) if re.fullmatch(r"\\(?:[pP]\{\w+\}|[sdwSDW])", t)}
    out = []
    for limit in LIMITS:
        inside, parts = False, []
        for token in tokens:
            if token in known:
                ranges = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in known[token] if a < limit)
                token = ranges if inside else f"[{ranges}]"
            elif token in "[]":
                inside = token == "["
            parts.append(token)
        out.append("".join(parts))
    return tuple(out)


@functools.cache
def _compiled(source: str) -> re.Pattern:
    return re.compile(source)


def fitting(text: str, sources: tuple[str, ...]) -> re.Pattern:
    """The cheapest splitter for the text."""
    if text.isascii():
        return _compiled(sources[0])
    return _compiled(sources[1 if len(text.encode("utf-16-le")) == 2 * len(text) else 2])


class Vocabulary:
    """Ids of pre-tokens by merge ranks; equal ones are merged once."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.merge = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})._core_bpe.encode_single_piece
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.ids, self.ends = [np.zeros(0, np.int32)], np.zeros(1, np.int64)

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces side by side, and where each piece's ids end (with a leading 0)."""
        new = list(set(pieces).difference(self.code))
        if len(self.code) + len(new) > REMEMBERED:
            self.forget()
            new = list(set(pieces))
        if new:
            found = [self.merge(p.encode()) for p in new]
            self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            self.ids = [np.concatenate([*self.ids, np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))])]
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(lengths)])
        code = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
        start, length = self.ends[code], self.ends[code + 1] - self.ends[code]
        ends = np.concatenate([[0], np.cumsum(length)])
        return self.ids[0][np.repeat(start - ends[:-1], length) + np.arange(ends[-1])], ends


# --- chunks -----------------------------------------------------------------------------------------------------------

_KEY = ("doc_part", "doc_row")


def chunks(docs: DataFrame, keep: tuple[str, ...], chunk: int, overlap: int) -> DataFrame:
    """Chunks of every text with their number and place, and the document's place in the table as its key."""
    schema = docs.select(*keep).schema
    fields = "doc_part int, doc_row long, no long, start long, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for some in slices(batch):
                kept, out = some.drop_columns(["text"]), []
                for i, text in enumerate(some.column("text").to_pylist()):
                    last = max(0, len(text) - overlap - 1) // chunk
                    out += [(i, row, no, no * chunk, text[no * chunk : (no + 1) * chunk + overlap] if no < last else text[no * chunk :]) for no in range(last + 1)]
                    row += 1
                index, rows, no, start, texts = zip(*out)
                columns = [pa.array(np.full(len(out), part, np.int32)), pa.array(rows, pa.int64()), pa.array(no, pa.int64()), pa.array(start, pa.int64()), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays([*kept.take(pa.array(index)).columns, *columns], names=[*kept.column_names, *_KEY, "no", "start", "text"])

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), fields])
    return docs.mapInArrow(run, types)


def stitched(pieces: DataFrame, pattern: str, overlap: int, label: str = "bpe-chunks") -> DataFrame:
    """``pieces`` (written chunks) with ``from_at`` and ``to_at``: the stretch of the document each one is responsible for.

    ``to_at`` is null for the last one. Neighbours that nowhere agree are merged and looked at again, together with
    the rest of their document, whose boundaries hold only once those before them do.
    """

    sources = splitters(pattern)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                head, tail = [], []
                for start, text in zip(some.column("start").to_pylist(), some.column("text").to_pylist()):
                    ends = np.fromiter((m.end() for m in fitting(text, sources).finditer(text)), np.int64)
                    sure = ends[ends <= len(text) - MARGIN]
                    head.append(start + np.concatenate([[0], sure[sure <= overlap]]).astype(np.int64))
                    tail.append(start + sure[sure >= len(text) - overlap])
                arrays = [some.column(c) for c in (*_KEY, "no", "start")]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(head, pa.list_(pa.int64())), pa.array(tail, pa.list_(pa.int64()))], names=[*_KEY, "no", "start", "head", "tail"])

    done = None
    while True:
        seen = pieces.select(*_KEY, "no", "start", "text").mapInArrow(marks, "doc_part int, doc_row long, no long, start long, head array<long>, tail array<long>")
        order = Window.partitionBy(*_KEY).orderBy("no")
        cut = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
        last = F.lead("no").over(order).isNull()
        cuts = seen.select(*_KEY, "no", "start", cut.alias("to_at"), last.alias("last"), F.lead("start").over(order).alias("next_start"))
        loose = ~F.col("last") & F.col("to_at").isNull()
        every = Window.partitionBy(*_KEY)
        cuts = cuts.select(
            *_KEY, "no", "to_at", "next_start",
            F.coalesce(F.lag("to_at").over(order), F.lit(0).cast("long")).alias("from_at"),
            F.max(loose).over(every).alias("open"),
            # Pieces up to and with the next one that is stitched go together.
            F.coalesce(F.sum(F.when(loose, 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("together"),
        )
        joined = stored(pieces.join(cuts, [*_KEY, "no"]), label)
        ready = joined.where(~F.col("open")).drop("open", "together", "next_start")
        done = ready if done is None else done.unionByName(ready)
        todo = joined.where("open")
        if todo.isEmpty():
            return done
        own = F.when(F.col("next_start").isNull(), F.col("text")).otherwise(F.expr("substring(text, 1, int(next_start - start))"))
        kept = [c for c in pieces.columns if c not in (*_KEY, "no", "start", "text")]
        parts = F.array_sort(F.collect_list(F.struct("no", F.col("start").alias("at"), own.alias("own"), "text")))
        merged = todo.groupBy(*_KEY, "together").agg(*[F.first(c).alias(c) for c in kept], parts.alias("parts"))
        whole = F.array_join(F.transform(F.expr("slice(parts, 1, size(parts) - 1)"), lambda p: p["own"]), "")
        end = F.element_at("parts", -1)
        merged = merged.select(*kept, *_KEY, F.col("parts")[0]["no"].alias("no"), F.col("parts")[0]["at"].alias("start"), F.concat(whole, end["text"]).alias("text"))
        pieces = stored(merged.select(*pieces.columns), label)


def _encoded(pieces: DataFrame, ranks: str, pattern: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and ``ids`` of the stretch of each piece."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.select(*keep).schema)
    sources = splitters(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None
        for batch in batches:
            vocabulary = vocabulary or Vocabulary(ranks, pattern)
            for some in slices(batch, limit=2 << 20):
                found = []
                for start, a, b, text in zip(*(some.column(c).to_pylist() for c in ("start", "from_at", "to_at", "text"))):
                    # What follows the stretch stays in sight of the pattern.
                    matches, stop = fitting(text, sources).finditer(text, a - start), len(text) if b is None else b - start
                    found.append([m[0] for m in matches if m.end() <= stop])
                ids, ends = vocabulary.encode(list(chain.from_iterable(found)))
                offsets = ends[np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in keep), lists], names=[*keep, "ids"])

    return pieces.mapInArrow(run, f"{types}, ids array<int>")


def encode(docs: DataFrame, ranks: str, pattern: str, keep: tuple[str, ...] = (), chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and ``ids`` (array<int>) of every text, by the ranks of the file ``ranks``."""
    keep = ("doc_id", *keep)
    rows = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    alone = F.length("text") <= chunk + overlap
    nothing = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    short = rows.where(alone).select("*", zero.alias("start"), zero.alias("from_at"), nothing.alias("to_at"))
    ids = _encoded(short, ranks, pattern, keep)
    long = rows.where(~alone)
    if long.isEmpty():
        return ids
    # The key of a document is given once and written; its chunks are dealt over all tasks.
    dealt = stored(chunks(long, keep, chunk, overlap).repartition(F.xxhash64(*_KEY, "no")), "bpe-chunks")
    parts = _encoded(stitched(dealt, pattern, overlap), ranks, pattern, (*keep, *_KEY, "no"))
    ordered = F.array_sort(F.collect_list(F.struct("no", "ids")))
    merged = parts.groupBy(*_KEY).agg(*[F.first(c).alias(c) for c in keep], ordered.alias("parts"))
    return ids.unionByName(merged.select(*keep, F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")))


def decode(encoded: DataFrame, ranks: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns of ``keep`` and ``data``: the raw bytes of all ids."""
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = ranks_of(ranks)
        tokens = [b""] * (max(table_.values()) + 1)
        for token, rank in table_.items():
            tokens[rank] = token
        length = np.array([len(t) for t in tokens], np.int64)
        start, data = np.cumsum(length) - length, np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            # A few rows at a time: their ids and bytes take several times the room of the batch.
            ends = np.cumsum(pc.list_value_length(batch.column("ids")).to_numpy())
            cuts = [0]
            while cuts[-1] < batch.num_rows:
                done = ends[cuts[-1] - 1] if cuts[-1] else 0
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, done + DECODED, "right"))))
            for a, b in zip(cuts[:-1], cuts[1:]):
                some = batch.slice(a, b - a)
                own = some.column("ids").flatten().to_numpy()
                if len(own) and not (0 <= own.min() and own.max() < len(tokens) and length[own].all()):
                    raise ValueError("an id is not in the vocabulary")
                stops = np.cumsum(length[own])
                out = data[np.repeat(start[own] - stops + length[own], length[own]) + np.arange(stops[-1] if len(own) else 0)]
                edges = np.append(0, stops)[np.append(0, ends[a:b] - (ends[a - 1] if a else 0))]
                blobs = [out[x:y].tobytes() for x, y in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in keep), pa.array(blobs, pa.binary())], names=[*keep, "data"])

    return encoded.select(*dict.fromkeys([*keep, "ids"])).mapInArrow(run, f"{types}, data binary")


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    both = decode(encoded, ranks, ("doc_id", "ids"))
    digits = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(digits.cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
