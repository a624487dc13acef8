"""Benchmark decontamination by winnowing, in DataFrame functions only.

Every window of ``window`` words keeps the smallest hash of its ``gram``-word runs (the leftmost on ties). Documents and
benchmark items choose alike, so every shared window of that many words shares a kept fingerprint at the same offset.
The kept fingerprints are joined, and each hit is extended to the whole benchmark window and compared word by word.
Items shorter than a window are windows of their own; their lengths (fewer than ``window`` different ones) are probed
with runs of exactly that length.

Only the kept fingerprints of the benchmark are broadcast, and only while they are at most ``broadcast_windows`` rows; a
larger benchmark is joined by a shuffle of the fingerprints. Texts are shuffled once, for documents with hits.

Defined results: null and empty texts have no words and are clean; a null or empty item has no window; repeated rows
give one row each; null ids are kept; items with equal windows all count; extra columns are ignored; an empty
benchmark leaves every document clean; an empty document table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ascii_lower, stored, table

WINDOW, GRAM = 10, 6
BROADCAST_WINDOWS = 100_000
#: Fixed value: what separates words (letters of either case and digits of ASCII and all other characters are kept).
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def split_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")


def lowered(word: Column) -> Column:
    return F.when(F.octet_length(word) == F.length(word), F.lower(word)).otherwise(ascii_lower(word))


def _run_hash(hashes: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + i) for i in range(size)])


def _until(last: Column) -> Column:
    """0, 1, ..., last; empty if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _kept(hashes: Column, grams: Column, window: int, gram: int) -> Column:
    """Place of the smallest run hash in each window, one entry a window."""
    width = window - gram + 1

    def leftmost(at: Column) -> Column:
        values = [F.get(grams, at + i) for i in range(width)]
        least = F.least(*values)
        place = F.lit(width - 1)
        for i in range(width - 2, -1, -1):
            place = F.when(values[i] == least, F.lit(i)).otherwise(place)
        return at + place

    return F.transform(_until(F.size(hashes) - window), leftmost)


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(fp, ahead, size, words, items)``: a row for each distinct window, with the offset of its kept fingerprint."""
    items = benchmark.select(F.col("item_id"), F.transform(split_words(F.col("text")), lowered).alias("words")).where(F.size("words") > 0)
    long, short = items.where(F.size("words") >= window), items.where(F.size("words") < window)
    windows = long.select("item_id", F.explode(F.transform(_until(F.size("words") - window), lambda s: F.slice("words", s + 1, window))).alias("words"))
    windows = windows.unionByName(short).groupBy("words").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    grams = F.transform(_until(F.size("words") - gram), lambda i: _run_hash(F.col("hashes"), i, gram))
    full = windows.where(F.size("words") == window).withColumn("hashes", hashes).withColumn("grams", grams)
    full = full.withColumn("ahead", F.get(_kept(F.col("hashes"), F.col("grams"), window, gram), F.lit(0)))
    out = full.select(F.get("grams", F.col("ahead")).alias("fp"), "ahead", F.lit(window).alias("size"), "words", "items")
    rest = windows.where(F.size("words") < window).withColumn("hashes", hashes)
    for size in range(1, window):
        part = rest.where(F.size("words") == size)
        out = out.unionByName(part.select(_run_hash(F.col("hashes"), F.lit(0), size).alias("fp"), F.lit(0).alias("ahead"), F.lit(size).alias("size"), "words", "items"))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """A row for each document: ``doc_id, version`` (a hash of the text), ``n_words, n_hit, items, spans``; spans are (start, size) in words."""
    known = stored(benchmark_windows(benchmark, window, gram), "benchmark-windows")
    sizes = {r.size: r.n for r in known.groupBy("size").agg(F.count("*").alias("n")).collect()}
    short = sorted(s for s in sizes if s < window)
    probes = known.groupBy("fp").agg(F.collect_list(F.struct("ahead", "size", "words", "items")).alias("windows"))
    if sum(sizes.values()) <= broadcast_windows:
        probes = F.broadcast(probes)

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).select("doc_id", "text", F.xxhash64("text").alias("version"))
    hashed = rows.select("doc_id", "version", F.transform(split_words(F.col("text")), lambda w: F.xxhash64(lowered(w))).alias("hashes"))
    grams = F.transform(F.when(F.size("hashes") >= window, _until(F.size("hashes") - gram)).otherwise(_until(F.lit(-1))), lambda i: _run_hash(F.col("hashes"), i, gram))
    placed = hashed.withColumn("grams", grams).withColumn("kept", F.array_distinct(_kept(F.col("hashes"), F.col("grams"), window, gram)))
    none = F.lit(None).cast("long").alias("n")
    found = F.transform("kept", lambda p: F.struct(p.alias("at"), F.get("grams", p).alias("fp"), none))
    for size in short:
        found = F.concat(found, F.transform(_until(F.size("hashes") - size), lambda p: F.struct(p.alias("at"), _run_hash(F.col("hashes"), p, size).alias("fp"), none)))
    # One row at place -1 carries the number of words, so that texts are split once unless they have hits. Its
    # fingerprint means nothing; it spreads such rows where the join is by a shuffle.
    spread = F.xxhash64("doc_id", "version", F.spark_partition_id())
    count = F.array(F.struct(F.lit(-1).alias("at"), spread.alias("fp"), F.size("hashes").cast("long").alias("n")))
    exploded = placed.select("doc_id", "version", F.explode(F.concat(count, found)).alias("x")).select("doc_id", "version", "x.at", "x.fp", "x.n")
    hit = exploded.join(probes, "fp", "left").where("at = -1 or windows is not null")
    starts = F.when(
        F.col("at") >= 0,
        F.transform("windows", lambda w: F.struct((F.col("at") - w["ahead"]).alias("start"), w["size"].alias("size"), w["words"].alias("words"), w["items"].alias("items"))),
    )
    # Rows that repeat id and text are one from here on, whatever their number: their hits are a set, combined in the tasks first.
    by_row = stored(
        hit.withColumn("starts", starts)
        .groupBy("doc_id", "version")
        .agg(F.sum(F.when(F.col("at") == -1, 1)).alias("copies"), F.max("n").alias("n_words"), F.flatten(F.collect_set("starts")).alias("starts")),
        "winnow-hits",
    )

    # Extend: the candidate's words against the document's, at that place; one text for all its copies.
    match = lambda x: F.col("doc_id").eqNullSafe(F.col(f"{x}_id")) & (F.col("version") == F.col(f"{x}_version"))
    under = lambda df, x, *more: df.select(F.col("doc_id").alias(f"{x}_id"), F.col("version").alias(f"{x}_version"), *more)
    hits = by_row.where(F.size("starts") > 0)
    texts = rows.join(under(hits, "hit"), match("hit"), "left_semi").groupBy("doc_id", "version").agg(F.first("text").alias("text"))
    near = hits.join(under(texts, "own", "text"), match("own"))
    words = F.transform(split_words(F.col("text")), lowered)
    same = F.filter("starts", lambda s: (s["start"] >= 0) & (F.slice(F.col("words"), F.greatest(s["start"], F.lit(0)) + 1, s["size"]) == s["words"]))
    checked = near.withColumn("words", words).select("doc_id", "version", "copies", "n_words", same.alias("hits"))
    checked = checked.select(
        "doc_id",
        "version",
        "copies",
        "n_words",
        F.size(F.array_distinct(F.flatten(F.transform("hits", lambda s: F.sequence(s["start"], s["start"] + s["size"] - 1))))).cast("long").alias("n_hit"),
        F.array_distinct(F.flatten(F.transform("hits", lambda s: s["items"]))).alias("items"),
        F.array_sort(F.array_distinct(F.transform("hits", lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size"))))).alias("spans"),
    )
    item, span = checked.schema["items"].dataType, checked.schema["spans"].dataType
    clean = by_row.where(F.size("starts") == 0).select(
        "doc_id", "version", "copies", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast(item).alias("items"), F.array().cast(span).alias("spans")
    )
    both = checked.unionByName(clean)
    return both.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copies", "copy")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a window of the benchmark."""
    hit = contamination(docs, benchmark).where("n_hit > 0").select("doc_id", "version").distinct().alias("hit")
    own = docs.alias("own")  # further columns may have any name
    same = F.col("own.doc_id").eqNullSafe(F.col("hit.doc_id")) & (F.xxhash64(F.col("own.text").cast("string")) == F.col("hit.version"))
    return own.join(hit, same, "left_anti")


def op2_decontam(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH iw AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
dw AS (SELECT doc_id, row_number() OVER () AS rid, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
win AS (SELECT DISTINCT item_id, w[s:s + least(10, len(w)) - 1] AS x FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(x) AS k FROM win),
occ AS (SELECT rid, k, s, w[s:s + k - 1] AS x FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM dw, sizes WHERE len(w) >= k)),
hits AS (SELECT rid, k, s, item_id FROM occ JOIN win USING (x)),
cover AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(s, s + k)) AS p FROM hits) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, sha256(string_agg(i, ',' ORDER BY i)) AS h FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hits) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cover USING (rid) LEFT JOIN its USING (rid)
"""
