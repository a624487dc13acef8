from __future__ import annotations

import hashlib
import random
import re

import cases
import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
ODD = ["it's 1²3 ½ x", "a  b\n\n c\t", "<|endoftext|> tail", "日本語 テキスト" * 30, "naïve Ünïcode's 42!!", "x" * 5000, "\x1c\x1d \x85 y", "'ll 'LL " * 40, "😀" * 300, " " * 700 + "x", "\n" * 400, "é", "don't " * 200, "a" * 200 + " b" * 90 + "c" * 300]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(PATH), special_tokens={})


def test_pre_tokens_split_as_the_library_does(library):
    signs = [chr(c) for c in (*range(0x3000), *range(0xFF00, 0x10000), *range(0x10000, 0x20000, 7), 0x16F0, 0x10EC5, 0x1C89) if not 0xD800 <= c < 0xE000]
    r = random.Random(3)
    texts = ["".join(signs)] + ["".join(r.choice(signs) + r.choice(["", " ", "a", "'s", "1"]) for _ in range(2000)) for _ in range(5)]
    for text in texts:
        pieces = [m[0] for m in bpe.fitting(text, bpe.splitters(PATTERN)).finditer(text)]
        assert "".join(pieces) == text
        assert [i for p in pieces for i in library.encode_ordinary(p)] == library.encode_ordinary(text)
    assert re.findall(bpe.splitters(r"\S+|\s+")[-1], "a\x1cb c") == ["a\x1cb", " ", "c"]


@pytest.mark.parametrize(("chunk", "overlap"), [(bpe.CHUNK, bpe.OVERLAP), (48, 40)])
def test_ids_are_the_librarys_and_decode_to_the_text(spark, library, chunk, overlap):
    r = random.Random(8)
    mixed = ["".join(r.choice(["word", " ", "  ", "\n", "'s", "!?", "12", "é", "長い", "q" * 60, " " * 50]) for _ in range(r.randrange(400))) for _ in range(40)]
    texts = ODD + mixed + [t for _, t, *_ in cases.documents()]
    rows = [(i // 2, t, "en", "src", 0) for i, t in enumerate(texts)] + [(None, "no id " * 30, "en", "src", 0)]
    encoded = bpe.encode(cases.frame(spark, rows), PATH, PATTERN, chunk=chunk, overlap=overlap)
    assert encoded.columns == ["doc_id", "ids"]
    got = sorted(((x.doc_id, list(x.ids), bytes(x.data)) for x in bpe.decode(encoded, PATH, ("doc_id", "ids")).collect()), key=str)
    want = sorted(((d, library.encode_ordinary(t or ""), (t or "").encode()) for d, t, *_ in rows), key=str)
    assert got == want


def test_neighbours_that_agree_nowhere_are_merged(spark):
    text = "start " + "a" * 700 + " middle " + "b" * 90 + " end" * 30
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    dealt = bpe.stored(bpe.chunks(docs, ("doc_id",), 64, 32), "test-chunks")
    pieces = sorted(bpe.stitched(dealt, PATTERN, 32).collect(), key=lambda p: p.from_at)
    assert 1 < len(pieces) < 10 and pieces[0].from_at == 0 and pieces[-1].to_at is None
    assert [p.to_at for p in pieces[:-1]] == [p.from_at for p in pieces[1:]]
    true = {m.end() for m in re.finditer(bpe.splitters(PATTERN)[-1], text)}
    assert all(p.to_at in true for p in pieces[:-1])


def test_other_ranks_and_pattern(spark):
    pattern = r"\p{Lu}?\p{Ll}+|\d|[^\p{L}\d]+|\p{L}"
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=bpe.ranks_of(path), special_tokens={})
    texts = ["Камель CaseWords 123 x" * 9, "ÄÖÜ groß", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in bpe.encode(docs, path, pattern, chunk=40, overlap=32).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in enumerate(texts)}


def test_unknown_ids_are_refused(spark):
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(spark.createDataFrame([(1, [5, 10**6])], "doc_id long, ids array<int>"), PATH).collect()


def test_query_digests(spark, library, tmp_path):
    cases.frame(spark, [(1, "two words", "en", "s", 0), (1, None, "en", "s", 0), (2, "", "en", "s", 0)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.op13_bpe(spark, str(tmp_path)).collect()}
    ids = library.encode_ordinary("two words")
    empty = hashlib.sha256(b"").hexdigest()
    assert got == {(1, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(b"two words").hexdigest()), (1, 0, empty, empty), (2, 0, empty, empty)}


def test_empty_table(spark):
    encoded = bpe.encode(cases.frame(spark, []), PATH, PATTERN)
    assert encoded.count() == 0 and bpe.decode(encoded, PATH).count() == 0


def test_long_white_space_does_not_end_the_task(spark):
    # The library's own pattern gives up on this; its meaning is one pre-token of all but the last sign, then the rest.
    n = 1_200_000
    docs = spark.createDataFrame([(1, "a" + "\n" * n + "b")], "doc_id long, text string")
    row = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH, ("doc_id", "ids")).first()
    assert re.fullmatch(rb"a\n+b", bytes(row.data)) and len(row.data) == n + 2
