from __future__ import annotations

import cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontam

TEXT = cases.documents()


def items():
    texts = {d: t for d, t, *_ in TEXT}
    w = texts[1].split()
    return [(1, " ".join(w[5:40]).upper()), (2, "not there at all but long enough to hold a window of ten"), (3, " ".join(w[5:40])), (4, None), (5, ""), (6, "a b c"), (7, "w1"), (8, " ".join(w[100:110])), (9, "Éé " * 12), (10, "a " * 15)]


def run(spark, docs, benchmark, **options):
    found = decontam.contamination(docs, benchmark, **options)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    rows = found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(ids.cast("binary"), 256), F.col("n_hit") > 0).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("broadcast_windows", [0, 100_000])
def test_against_brute_force(spark, broadcast_windows):
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    assert run(spark, cases.frame(spark), benchmark, broadcast_windows=broadcast_windows) == cases.contaminated(TEXT, items())


def test_many_copies_cost_about_one(spark):
    import time

    w = [f"v{i}" for i in range(200)]
    benchmark = spark.createDataFrame([(i, " ".join(w[i : i + 60])) for i in range(0, 140, 7)], "item_id long, text string")
    one = cases.frame(spark, [(1, " ".join(w), "en", "s", 0)])
    run(spark, one, benchmark)
    start = time.perf_counter()
    (row,) = run(spark, one, benchmark)
    single = time.perf_counter() - start
    start = time.perf_counter()
    found = decontam.contamination(one.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10_000)))).repartition(4), benchmark)
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    got = found.groupBy("doc_id", "n_words", "n_hit", F.size("items").cast("long"), F.sha2(ids.cast("binary"), 256), F.col("n_hit") > 0).count().collect()
    assert [tuple(r) for r in got] == [(*row, 10_000)] and time.perf_counter() - start < 20 * max(single, 1)


def test_clashing_names(spark):
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    docs = cases.frame(spark).withColumns({c: F.lit("x") for c in ("hit_id", "hit_version", "own_id", "copies")})
    assert decontam.without_contaminated(docs, benchmark).count() == decontam.without_contaminated(cases.frame(spark), benchmark).count()


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert run(spark, cases.frame(spark), nothing) == cases.contaminated(TEXT, [])
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    assert run(spark, cases.frame(spark, []), benchmark) == []


def test_no_python_in_the_plan(spark):
    plan = decontam.contamination(cases.frame(spark), spark.createDataFrame(items(), "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_contaminated_documents_go(spark):
    benchmark = spark.createDataFrame(items(), "item_id long, text string")
    left = decontam.without_contaminated(cases.frame(spark), benchmark).select("doc_id", "text").collect()
    clean = [d for d, *_, hit in cases.contaminated(TEXT, items()) if not hit]
    assert sorted((r.doc_id for r in left), key=str) == sorted(clean, key=str)
