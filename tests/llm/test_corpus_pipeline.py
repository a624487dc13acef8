"""The pipeline stage by stage against brute force, and the registered queries against their SQL."""

from __future__ import annotations

import cases
import pytest
from cases import base_spans, contaminated, fingerprint, linked
from compare import mismatch, oracle_connection
from conftest import SF

import corpus_pipeline
from tidemark.llm import toxicity
from tidemark.llm.common import stored, table
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    assert mismatch(QUERIES[name](spark, SF), oracle_connection(SF), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_a_row_for_every_document(spark, name):
    ids = {r.doc_id for r in QUERIES[name](spark, SF).select("doc_id").collect()}
    assert ids == {r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect()}


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    before = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), f"test-{name}")
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == {r[0] for r in before}
            break
        assert out.columns == columns
        after = {tuple(r) for r in out.collect()}
        if name == "toxicity":
            want = {r.doc_id for r in toxicity.toxicity(docs, table(spark, SF, "labels")).collect() if r.score < 0.5}
            assert after == {r for r in before if r[0] in want} and len(after) <= len(before)
        elif name == "simhash":
            rows = sorted(before)
            roots = linked([fingerprint(r[1]) for r in rows])
            assert after == {rows[i] for i in set(roots)}
        elif name == "decontamination":
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            clean = {r[0] for r in contaminated(sorted(before), items) if not r[-1]}
            assert after == {r for r in before if r[0] in clean}
        elif name == "privacy":
            old, new = {r[0]: r for r in before}, {r[0]: r for r in after}
            assert set(old) == set(new)
            for i, r in new.items():
                assert not base_spans(r[1]) and r[2:4] == old[i][2:4]
                assert r == old[i] or r[4] == len(r[1]) and "[" in r[1]
        docs, before = out, after


def test_odd_documents(spark):
    """Nulls in every column, repeated rows, extra columns with the operators' own names, and no rows at all."""
    rows = [*cases.documents(), (None, None, None, None, None), (900, "plain", None, None, None), (900, "plain", None, None, None), (901, "a@b.c " * 3000, None, "s", 7)]
    for docs in (cases.frame(spark, rows), cases.frame(spark, [])):
        empty = docs.isEmpty()
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, stored(stage(spark, docs, SF), f"odd-{name}")
            if name != "packing":
                assert docs.columns == list(corpus_pipeline.COLUMNS)
                assert docs.count() <= before.count()
        assert docs.isEmpty() == empty
        if not empty:
            kept = {r.doc_id: r for r in before.collect()}
            assert kept[900].text == "plain" and kept[900].n_chars is None and kept[901].text == "[EMAIL] " * 3000
            assert sum(r.text in (None, "") for r in before.collect()) == 1 and docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_batches_of_python_stages_are_small(spark):
    """What an executor and its worker hold at a time follows bytes and not 10,000 rows; tighter settings stay."""
    import pyarrow as pa

    from tidemark.llm import common

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["size"])

    text, before = "a plain word " * 2000, spark.conf.get(common._BATCH)
    docs = cases.frame(spark, [(i, text, "en", "s", len(text)) for i in range(1000)]).coalesce(1)
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name in ("toxicity", "simhash", "packing"):
                spark.conf.set(common._BATCH, "64m")
                stage(spark, docs.limit(3), SF)
                seen = [r[0] for r in docs.select("text").mapInArrow(sizes, "size long").collect()]
                assert max(seen) < common.SLICE_BYTES and sum(seen) > 1000 * len(text)
                spark.conf.set(common._BATCH, "1m")
                stage(spark, docs.limit(3), SF)
                assert spark.conf.get(common._BATCH) == "1m"
    finally:
        spark.conf.set(common._BATCH, before)
