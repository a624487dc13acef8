from __future__ import annotations

import random
import zlib

import cases
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import ordinal, rules, toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=900):
    """Plain, toxic, disguised toxic and junk texts with labels."""
    r = random.Random(4)
    plain = ["the", "river", "morning", "walked", "house", "garden", "letter", "window", "summer", "quiet", "bread", "lantern", "meadow", "stone", "paper", "winter"]
    bad = ["stupid", "idiot", "moron"]
    rows, labels = [], []
    for i in range(n):
        w = [r.choice(plain) for _ in range(r.randrange(50, 90))]
        kind = i % 5
        if kind == 1:
            w[r.randrange(len(w))] = r.choice(bad)
        if kind == 2:
            w[r.randrange(len(w))] = r.choice(["5tup1d", "m0ron", "stuuupid", "i.d.i.o.t", "1d1ot", "s t u p i d"])
        if kind == 3:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w), "en", "src", 0))
        labels.append((i, int(kind != 3), int(kind in (1, 2))))
    return rows, labels


def test_spelling_is_restored(spark):
    rows, _ = corpus()
    model = toxicity.character_model(toxicity.character_counts(cases.frame(spark, rows)))
    for disguised, plain in {"5tup1d": "stupid", "m0ron": "moron", "i.d.i.o.t": "idiot", "stuuuupid": "stupid", "river,": "river", "4111": "4111", "garden": "garden"}.items():
        assert toxicity.restored(disguised, model) == plain


def test_spaced_runs_end_with_their_document(spark):
    rows, _ = corpus()
    model = toxicity.character_model(toxicity.character_counts(cases.frame(spark, rows)))

    def read(texts):
        values, codes, starts = toxicity._Reader(model, lambda words: words)(pa.array(texts))
        return [[values[c] for c in codes[a:b] if c >= 0] for a, b in zip(starts[:-1], starts[1:])]

    texts = ["s t u p i d river", "vitamin c", "s t u p i d", "i d i o t", "", None, "m o r o n", "x !", "s t u p i d"]
    alone = [read([t])[0] for t in texts]
    assert read(texts) == alone and read(texts[::-1]) == alone[::-1]
    assert str(alone[2]).count("stupid") == 1 and "idiot" in str(alone[3]) and "moron" in str(alone[6])


def test_spaced_text_is_read_whole(spark):
    rows, labels = corpus()
    model = toxicity.character_model(toxicity.character_counts(cases.frame(spark, rows)))

    def read(text):
        return [w for words in toxicity._Reader(model, lambda words: words)(pa.array([text]))[0] for w in words]

    spaced = " ".join("thequietrivermorninggardenwindowsummer")
    assert "stupid" in read("a s t u p i d") and "moron" in read("y o u m 0 r o n")
    for copies in (2, 40, 400):
        assert "idiot" in read(f"{' '.join([spaced] * copies)} i d i o t {spaced}")
        assert read(" ".join([spaced + " m o r o n"] * copies)).count("moron") == copies
    extra = [(6000, "a s t u p i d " + rows[0][1], "en", "src", 0), (6001, f"{spaced} {spaced} s t u p i d {rows[0][1]}", "en", "src", 0), (6002, f"{spaced} {spaced} {rows[0][1]}", "en", "src", 0)]
    score = {r.doc_id: r.score for r in toxicity.toxicity(cases.frame(spark, rows + extra), spark.createDataFrame(labels, LABELS)).collect()}
    assert score[6000] > 0.5 and score[6001] > 0.5 and score[6002] < 0.5


def test_every_disguise_is_decoded(spark, monkeypatch):
    rows, labels = corpus()
    model = toxicity.character_model(toxicity.character_counts(cases.frame(spark, rows)))
    disguises = {"1d107": "idiot", "1d!07": "idiot", "mo*ron": "moron", "st.upid": "stupid", "stu-pid": "stupid", "st_up_id": "stupid", "i'd'i'o't": "idiot", "stuupid": "stupid"}
    disguises |= {"iidiiot": "idiot", "st" + "u" * 60 + "pid": "stupid", "the.quiet.garden.has.one.stu.pid.lantern.and.a.window": "stupid", "a.s.t.u.p.i.d": "stupid"}
    for disguised, plain in disguises.items():
        assert plain in toxicity.readings(disguised, model), disguised
    assert toxicity.readings("4111", model) == ["4111"] and "letter" in toxicity.readings("letter,", model)
    r = random.Random(2)
    for word in ("".join(r.choice("aabbtteoinr") for _ in range(12)) for _ in range(300)):
        assert toxicity.squeezed(word, model) == toxicity.decoded(word, model)[0]
    long = "st0neriver-" * 100
    whole = toxicity.decoded(long, model)
    monkeypatch.setattr(toxicity, "STRETCH", 7)
    assert toxicity.decoded(long, model) == whole
    monkeypatch.undo()
    extra = [(6000 + i, f"{w} {rows[0][1]}", "en", "src", 0) for i, w in enumerate(disguises)]
    score = {x.doc_id: x.score for x in toxicity.toxicity(cases.frame(spark, rows + extra), spark.createDataFrame(labels, LABELS)).collect()}
    assert all(score[d] > 0.5 for d, *_ in extra)


def test_toxicity_held_out(spark):
    rows, labels = corpus()
    extra = [(None, rows[1][1], "en", "src", 0), (5000, None, "en", "src", 0), (5001, "", "en", "src", 0), (5002, "word " * 200_000, "en", "src", 0), rows[1]]
    scored = toxicity.toxicity(cases.frame(spark, rows + extra), spark.createDataFrame([*labels, *labels[:3], (None, 1, 1), (5, None, None)], LABELS), keep=("text",)).collect()
    assert len(scored) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in scored)
    truth = {i: t for i, _, t in labels}
    held = [r for r in scored if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in held]) > 0.97
    assert all(r.score < 0.5 for r in scored if not r.text)


def test_toxicity_without_labels(spark):
    rows, _ = corpus(20)
    none = spark.createDataFrame([], LABELS)
    assert {r.score < 0.01 for r in toxicity.toxicity(cases.frame(spark, rows), none).collect()} == {True}
    assert toxicity.toxicity(cases.frame(spark, []), none).count() == 0


def test_statistics_against_brute_force(spark):
    got = rules.statistics(cases.frame(spark)).collect()
    want = [(d, *cases.statistics(t)) for d, t, *_ in cases.documents()]
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)


def test_repeated_words_of_many_distinct_words():
    codes = np.array([1, 2, 3, 9, 1, 2, 3, 8, 1, 2, 4])
    assert rules.repeated_words(codes) == rules.repeated_words(codes + (1 << 40)) == 6


def test_isolation_forest(spark):
    r = np.random.default_rng(1)
    x = np.vstack([r.normal(0, 1, (2000, 3)), [[9, 9, 9]]])
    score = rules.Forest(x[:2000]).score(x)
    assert score.argmax() == 2000 and score.min() > 0 and score.max() < 1
    rows, labels = corpus()
    odd = [(7000 + k, " ".join(f"{rows[k][1].split()[i]}{i}$$" for i in range(50)), "en", "src", 0) for k in range(30)]
    marked = [(d, 0, 0) for d, *_ in odd[1:]]
    kept = {r.doc_id: r for r in rules.quality(cases.frame(spark, rows + odd), spark.createDataFrame(labels + marked, LABELS)).collect()}
    good = [i for i, q, _ in labels if q]
    assert np.mean([kept[i].kept for i in good if not kept[i].base_failed]) > 0.99 and not kept[7000].kept


def test_rules_without_labels(spark):
    got = rules.quality(cases.frame(spark), spark.createDataFrame([], LABELS)).collect()
    assert all(r.kept != r.base_failed for r in got) and len(got) == len(cases.documents())
    assert rules.quality(cases.frame(spark, []), spark.createDataFrame([], LABELS)).count() == 0


def test_ordinal_held_out(spark):
    rows, labels = corpus()
    extra = [(None, rows[1][1], "en", "src", 0), (5000, None, "en", "src", 0), (5001, "", "en", "src", 0)]
    got = {r.doc_id: r for r in ordinal.graded(cases.frame(spark, rows + extra), spark.createDataFrame(labels, LABELS)).collect()}
    held = [x for x in labels if zlib.crc32(str(x[0]).encode()) % 5 == 0]
    assert np.mean([got[i].selected == bool(q) for i, q, _ in held]) > 0.97
    mean = [np.mean([got[i].expected_grade for i, q, t in held if q * (2 - t) == k]) for k in range(3)]
    assert mean[0] < mean[1] < mean[2] and all(0 <= r.tail_probability <= 1 for r in got.values())


def test_cumulative_links_are_ordered():
    tails = ordinal.CumulativeLink(np.zeros(1), np.array([-1.0, 0.5])).tails(np.linspace(-3, 3, 9))
    assert (tails[:, 0] > tails[:, 1]).all() and (np.diff(tails, axis=0) > 0).all()


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_ordinal_without_grades(spark, labels):
    got = ordinal.graded(cases.frame(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert len({(r.expected_grade, r.selected) for r in got}) == 1 and len(got) == len(cases.documents())


def test_rules_are_calibrated_on_every_labelled_row(spark):
    """More rows than a tree draws: thresholds are those of numpy over all rows that are not held out."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = 700
    rows = [(i, *(int(x) for x in (100, 400 + rng.integers(200), rng.integers(9), 0, rng.integers(20), 5, rng.integers(30), 400, rng.integers(4)))) for i in range(n)]
    rows = [(*r, int(rng.random() < 0.8)) for r in rows] + [(n + i, 100, 3000, 90, 4, 40, 5, 390, 400, 50, 0) for i in range(40)]
    train = spark.createDataFrame(rows, "doc_id long, " + ", ".join(f"{c} long" for c in rules._COUNTED) + ", quality int")
    judge = rules._judge(train.repartition(5), 0.01)
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("doc_id", *rules._COUNTED, "quality"))})
    good, drawn = np.array([r[-1] for r in rows]) > 0, 0
    for score, got in zip(judge.scores(rules._shares(table)), judge.thresholds):
        want = np.quantile(score[good], 0.99, method="higher")
        beyond = score[~good][score[~good] > want]
        apart = len(beyond) > rules.APART * (~good).sum()
        drawn += apart
        assert got == pytest.approx((want + np.quantile(beyond, 0.05)) / 2 if apart else score[good].max())
    assert drawn
    assert rules._judge(train.repartition(2), 0.01).thresholds == judge.thresholds


def test_ordinal_model_learns_from_every_shard(spark):
    """A word that only a few labelled rows hold counts wherever they lie in the order of the ids' hashes."""
    texts = [(i, f"plain words of row {i % 7} " + ("awful " * 3 if i % 2 else "fine " * 3)) for i in range(400)]
    labels = [(i, 1 - i % 2, 0) for i in range(400)]
    docs, marked = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    whole = {r.doc_id: r for r in ordinal.graded(docs, marked).collect()}
    dealt = {r.doc_id: r for r in ordinal.graded(docs.repartition(3), marked, shard_rows=50).collect()}
    for got in (whole, dealt):
        assert all(got[i].selected == (i % 2 == 0) for i in range(400))
    again = {r.doc_id: r for r in ordinal.graded(docs.repartition(7), marked, shard_rows=50).collect()}
    assert all(abs(again[i].tail_probability - dealt[i].tail_probability) < 1e-12 for i in range(400))
    names = {}
    original = ordinal._averaged

    def seen(train):
        names.update(rows=train.count(), shards=train.select("shard").distinct().count())
        return original(train)

    ordinal._averaged = seen
    try:
        ordinal.graded(docs, marked, shard_rows=50)
    finally:
        ordinal._averaged = original
    assert names["rows"] > 300 and names["shards"] > 4


def test_ordinal_moves_texts_in_proportion(spark, monkeypatch):
    """The join that carries texts is the same however few labels there are, and texts of the held-out fold do not enter it."""
    docs = spark.createDataFrame([(i, f"words of row {i}") for i in range(200)], "doc_id long, text string")
    marked, plans, original = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], LABELS), {}, ordinal.stored

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return original(df, label)

    monkeypatch.setattr(ordinal, "stored", seen)
    got = ordinal.graded(docs, marked).collect()
    plan = plans["ordinal-rows"]
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    exchange = plan.index("Exchange hashpartitioning(doc_id")
    assert "crc32" in plan[exchange:]
    assert sorted(r.doc_id for r in got) == list(range(200))  # the held-out fold is scored all the same
