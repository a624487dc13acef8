from __future__ import annotations

import gzip
import hashlib
import os

import pytest

from tidemark.llm import warc

PAGES = [(i, f"http://x/{i % 7}\r\nX: {i}", ("<p>é same</p>" * 20) if i % 3 == 0 else f"<p>{i}</p>" * (i % 40)) for i in range(1, 200)]
PAGES += [(5, "http://again", "<b>" * 60), (5, "http://again", "<b>" * 60), (5, "http://other", "<b>" * 60), (900, None, None), (901, "", ""), (None, "http://n", "<p>é same</p>" * 20), (None, None, "short"), (10**15, "http://far", "<i>" * 100_000)]


def expected():
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out, seen = [], set()
    for page, _, html in PAGES:
        body = (html or "").encode()
        key = html or ""
        revisit = len(body) >= 100 and page is not None and (first[key] != page or (page, key) in seen)
        seen.add((page, key))
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first[key] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_bytes, roll_bytes", [(1 << 30, 1 << 30), (20_000, 1500)])
def test_round_trip(spark, tmp_path, shard_bytes, roll_bytes):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'extra' AS digest", "1 AS shard")
    files = []
    for run in ("one", "two"):
        root = f"file://{tmp_path}/{run}"
        manifest = warc.write_archives(df.repartition(3 if run == "one" else 5), root, shard_bytes, roll_bytes)
        got = warc.read_archives(manifest, root)
        rows = got.collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str) == expected()
        assert all(hashlib.sha256(bytes(r.payload)).hexdigest() == r.payload_digest for r in rows if r.record_type == "response")
        names = sorted(n for n in os.listdir(tmp_path / run) if n.endswith(".gz"))
        assert names == sorted(r.name for r in manifest.collect()) and not [n for n in os.listdir(tmp_path / run) if n.startswith("_temporary")]
        files.append({n: (tmp_path / run / n).read_bytes() for n in names})
    assert files[0] == files[1]  # the same bytes from other partitions
    for data in files[0].values():
        text = gzip.decompress(data)
        assert text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and b"\r\nX: " not in text


def test_damage_is_noticed(spark, tmp_path):
    root = f"file://{tmp_path}/a"
    manifest = warc.write_archives(spark.createDataFrame(PAGES, "page_id long, url string, html string"), root)
    name = manifest.first().name
    data = (tmp_path / "a" / name).read_bytes()
    (tmp_path / "a" / name).write_bytes(data[: len(data) // 2])
    with pytest.raises(Exception):
        warc.read_archives(manifest, root).collect()


def test_empty_table(spark, tmp_path):
    manifest = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/e")
    assert manifest.count() == 0 and warc.read_archives(manifest, f"file://{tmp_path}/e").count() == 0


@pytest.mark.parametrize("far", [True, False])
def test_shards_are_even(spark, tmp_path, far):
    """An id far off all others, or one id on a third of all pages, leaves shards of about the wanted size."""
    body = "concat(repeat(hex(id), 100), '')"
    df = spark.range(20_000).selectExpr("id as page_id", "'u' as url", f"{body} as html")
    if far:
        df = df.unionByName(spark.range(1).selectExpr("1000000000000000L as page_id", "'u' as url", "'x' as html"))
        df = df.unionByName(spark.range(1).selectExpr("-9223372036854775808L as page_id", "'u' as url", "'x' as html"))
    else:
        df = df.selectExpr("if(page_id % 3 = 0, 77L, page_id) as page_id", "url", "html")
    root = f"file://{tmp_path}/s"
    manifest = warc.write_archives(df, root, 1 << 20, 1 << 30)
    back = warc.read_archives(manifest, root).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in back) == sorted(tuple(r) for r in df.selectExpr("page_id", "length(html)").collect())
    sizes = {}
    for r in back:
        sizes[r.file] = sizes.get(r.file, 0) + r.payload_bytes + 600
    whole = sum(sizes.values())
    assert abs(len(sizes) - whole / (1 << 20)) <= 1.5 and max(sizes.values()) <= 1.2 * (1 << 20)
    assert sorted(sizes.values())[1] >= 0.8 * (1 << 20)  # all but the last
    order = sorted(sizes)
    for one, two in zip(order, order[1:]):
        assert max(r.page_id for r in back if r.file == one) <= min(r.page_id for r in back if r.file == two)
