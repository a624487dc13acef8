from __future__ import annotations

import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["it's 1²3 ½ x", "a  b\n\n c\t", "<|endoftext|> tail", "日本語 テキスト", "naïve Ünïcode's 42!!", "x" * 5000, "\x1c\x1d \x85 y", "_a_ __ 'll 'LL", "😀😀", "é"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers(tokenizer):
    texts = ODD + [t or "" for _, t, *_ in cases.documents()]
    encoder = packing.Encoder(PATH)
    for _ in range(2):
        assert [x.tolist() for x in encoder.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("length", [64, 2048])
def test_pieces(spark, tokenizer, length):
    rows = [(i, t, "en", "src", 0) for i, t in enumerate(ODD + [t for _, t, *_ in cases.documents()])]
    got = packing.pack(cases.frame(spark, rows), length=length, with_ids=True).collect()
    stream = {}
    for i, t, *_ in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        own, at = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start), 0
        for r in own:
            piece = ids[at : at + r.length].tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(piece), piece) and r.length > 0
            stream.setdefault(r.sequence_id, []).append((r.offset, r.length))
            at += r.length
        assert at == len(ids)
    for sequence, pieces in stream.items():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at == length or sequence == max(stream)
    assert sorted(stream) == list(range(len(stream)))


def test_empty_table(spark):
    assert packing.pack(cases.frame(spark, [])).count() == 0
