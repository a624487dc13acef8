"""Concatenate-and-cut packing of tokenized documents into sequences of a fixed length.

Two passes. The first tokenizes every whole document and writes its ids with a running offset inside the partition;
the second adds up partition totals (one number a partition), which turns the running offsets into places in one global
stream, and cuts the stream at multiples of the sequence length. Only the last sequence can be short, and no id moves
between tasks: the stream's order is that of the partitions and of the rows in them.

Defined results: a null text counts as empty; an empty document is its end id alone; a document cut by sequence bounds
gives one piece for each sequence it touches; repeated rows and null ids are documents of their own; extra columns
are ignored; an empty table gives no piece. The file of the tokenizer is a parameter.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import slices, stored, table

SEQUENCE = 2048
END_ID = 1
#: Distinct pieces of text whose ids a task remembers; beyond it starts afresh. A matter of speed only.
REMEMBERED = 300_000

# Letters and signs on which Python's and the tokenizer's own classes agree; any other text takes the tokenizer whole.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_PLAIN = re.compile(rf"[\t\n\r\x20-\x7e{_LETTERS}]*")
_PIECES = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[!-/:-@\[-`{{-~]+|\s+(?!\S)|\s+")


LONG_PIECE = 200  # characters of a piece above which the tokenizer's own algorithm is faster


def _merger(path: str):
    """Byte-pair merging of one piece by the vocabulary of the file, or None if its merges are not in the order of its ids.

    It gives the ids that the tokenizer gives for a piece, without an object for every piece.
    """
    import tiktoken

    model = json.loads(Path(path).read_text())["model"]
    vocab = model.get("vocab", {})
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    if model.get("type") != "BPE" or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    # The printable stand-ins of bytes: those that print stand for themselves, the others follow 256 in order.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
    core = tiktoken.Encoding("pieces", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe
    return core.encode_single_piece


class Encoder:
    """Ids of texts by a byte-level tokenizer file; equal pieces of plain text are encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = _merger(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, pieces: list[str]) -> None:
        if self.merge is None:
            found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        else:
            found = [self.merge(p.encode()) if len(p) <= LONG_PIECE else self.tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.code.update(zip(pieces, range(len(self.code), len(self.code) + len(pieces))))
        self.start = np.concatenate([self.start, self.used + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.used += len(flat)

    def plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        lists = [_PIECES.findall(t) if self.plain(t) else None for t in texts]
        flat = list(chain.from_iterable(x for x in lists if x is not None))
        new = set(flat).difference(self.code)
        if new:
            if len(self.code) + len(new) > REMEMBERED:
                self.forget()
                new = set(flat)
            self.learn(sorted(new))
        codes = np.fromiter(map(self.code.__getitem__, flat), np.int64, len(flat))
        lengths = self.length[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.ids[np.repeat(self.start[codes] - ends[:-1], lengths) + np.arange(ends[-1])]
        cuts = ends[np.fromiter(accumulate((len(x) for x in lists if x is not None), initial=0), np.int64)]
        parts = iter(zip(cuts[:-1], cuts[1:]))
        out = []
        for text, pieces in zip(texts, lists):
            if pieces is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32))
            else:
                a, b = next(parts)
                out.append(ids[a:b])
        return out


def tokenized(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """``(part, before, doc_id, n, ids)``: ids as little-endian numbers of 16 bits if the vocabulary allows, else 32; ``before`` the ids of the partition ahead of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, encoder = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            encoder = encoder or Encoder(tokenizer)
            kind = "<u2" if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
            for piece in slices(batch, limit=2 << 20):
                ids = [np.append(x, np.uint32(end_id)) for x in encoder.encode([t or "" for t in piece.column("text").to_pylist()])]
                n = np.array([len(x) for x in ids], np.int64)
                at = before + np.cumsum(n) - n
                before += int(n.sum())
                yield pa.record_batch(
                    [pa.array(np.full(len(n), part, np.int32)), pa.array(at), piece.column("doc_id"), pa.array(n), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary())],
                    names=["part", "before", "doc_id", "n", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "part int, before long, doc_id long, n long, ids binary")


def cut(tokens: DataFrame, length: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Boundary records: one row for each piece of a document in a sequence; ``with_ids`` adds the piece's ids."""
    # One number for each partition of the first pass goes out with the tasks.
    totals = sorted((r.part, r.n) for r in tokens.groupBy("part").agg(F.sum("n").alias("n")).collect())
    base = dict(zip((part for part, _ in totals), accumulate((n for _, n in totals), initial=0)))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for rows in slices(batch, "ids"):
                out: list[list] = [[] for _ in names]
                for part, before, doc, n, blob in zip(*(rows.column(c).to_pylist() for c in ("part", "before", "doc_id", "n", "ids"))):
                    at, start = base[part] + before, 0
                    view = memoryview(np.frombuffer(blob, f"<u{len(blob) // n}").astype("<u4")).cast("B")
                    while start < n:
                        sequence, offset = divmod(at + start, length)
                        size = min(length - offset, n - start)
                        ids = view[4 * start : 4 * (start + size)]
                        for column, value in zip(out, (doc, start, size, zlib.crc32(ids), n, sequence, offset, ids)):
                            column.append(bytes(value) if value is ids else value)
                        start += size
                yield pa.record_batch([pa.array(v, pa.binary() if c == "ids" else pa.int64()) for c, v in zip(names, out)], names=names)

    return tokens.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, length: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return cut(stored(tokenized(docs, str(tokenizer), end_id), "packing-ids"), length, with_ids)


def op9_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
