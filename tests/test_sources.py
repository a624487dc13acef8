"""CSV feeds, the curated store, append-only tables and the streaming loader, on temporary folders."""

from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from tidemark.operators.quality import structural_quality
from tidemark.sources import history
from tidemark.sources import store as S
from tidemark.sources import transactions as T
from tidemark.streaming.ingest import stream_deduplicated, stream_transactions

HEAD = "Invoice,StockCode,Quantity,InvoiceDate,Price,CustomerID\n"
JAN = "100,A,2,10-01-2010 10:00,10.0,1\n100,A,2,10-01-2010 10:00,10.0,1\n101,B,1,31-01-2010 23:59,2.5,17850.0\n102,B,1,05-01-2010 09:30,2.5,\n"
FEB = "200,A,-1,01-02-2010 00:00,10.0,1\n"


@pytest.fixture
def drops(tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "jan.csv").write_text(HEAD + JAN)
    (tmp_path / "in" / "deep" / "feb.CSV").write_text(HEAD + FEB)
    (tmp_path / "in" / "note.txt").write_text("no data")
    return tmp_path


def test_csv_scan(spark, drops):
    tx = T.scan_transactions(spark, str(drops / "in"))
    assert tx.count() == 5 and tx.schema == T.TRANSACTIONS
    assert tx.agg(F.max("InvoiceDate")).first()[0] == datetime(2010, 2, 1)
    assert {r.CustomerID for r in tx.collect()} == {1, 17850, None}
    assert T.scan_transactions(spark, [str(drops / "in" / "jan.csv")]).count() == 4


def test_csv_errors(spark, drops):
    with pytest.raises(ValueError):
        T.scan_transactions(spark, [])
    (drops / "empty").mkdir()
    with pytest.raises(ValueError):
        T.scan_transactions(spark, str(drops / "empty"))
    (drops / "bad.csv").write_text(HEAD + "1,A,1,2010-01-10,1.0,1\n2,A,x,10-01-2010 10:00,1.0,1\n")
    with pytest.raises(Exception):
        T.scan_transactions(spark, str(drops / "bad.csv")).collect()
    checks = {r.check_name: r for r in structural_quality(T.scan_raw(spark, str(drops / "bad.csv"))).collect()}
    assert checks["date_not_parsed"].observed == checks["quantity_not_numeric"].observed == 1 and not checks["date_not_parsed"].passed
    (drops / "wide.csv").write_text(HEAD.strip() + "".join(f",c{i}" for i in range(60)) + "\n")
    with pytest.raises(ValueError, match="columns"):
        T.scan_raw(spark, str(drops / "wide.csv"))
    (drops / "short.csv").write_text("Invoice,StockCode,Quantity,InvoiceDate,Price\n1,A,1,10-01-2010 10:00,1.0\n")
    short = T.scan_raw(spark, str(drops / "short.csv"))
    assert [(r.check_name, r.passed) for r in structural_quality(short).collect()] == [("missing_columns", False)]
    with pytest.raises(ValueError, match="CustomerID"):
        T.scan_transactions(spark, str(drops / "short.csv"))


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + "1,A,1.7,10-01-2010 10:00,0.00004,1\n")
    (tmp_path / "b.csv").write_text('\ufeffCountry,CustomerID,Price,InvoiceDate,Quantity,StockCode,Invoice,Description\nUK,2,1.5,11-01-2010 10:00,3,B,2,"a, b"\n')
    rows = rows_of(T.scan_transactions(spark, str(tmp_path)), "Invoice")
    assert [(r["Invoice"], r["Quantity"], r["Price"], r["CustomerID"], r["Country"], r["Description"]) for r in rows] == [
        ("1", 1.7, 0.00004, 1, None, None),
        ("2", 3.0, 1.5, 2, "UK", "a, b"),
    ]


QUOTED = [("12\"\" ruler, wood", '12" ruler, wood'), ('a, b \"\"c\"\"', 'a, b "c"'), ("two\nlines", "two\nlines"), ("plain", "plain")]


def test_quoted_cells(spark, tmp_path):
    (tmp_path / "in").mkdir()
    head = "Invoice,Description,StockCode,Quantity,InvoiceDate,Price,CustomerID\n"
    body = "".join(f'{i},"{cell}",A,{i + 1},10-01-2010 10:00,1.5,{i}\n' for i, (cell, _) in enumerate(QUOTED))
    (tmp_path / "in" / "a.csv").write_text(head + body)
    want = [(str(i), float(i + 1), 1.5, i, text) for i, (_, text) in enumerate(QUOTED)]
    of = lambda df: [(r["Invoice"], r["Quantity"], r["Price"], r["CustomerID"], r["Description"]) for r in rows_of(df, "Invoice")]
    assert of(T.scan_transactions(spark, str(tmp_path / "in"))) == want
    store, bad, state = (str(tmp_path / n) for n in ("store", "bad", "state"))
    stream_transactions(spark, str(tmp_path / "in"), store, bad, state).awaitTermination()
    assert of(S.read_curated(spark, store)) == want and not list((tmp_path / "bad").rglob("*.parquet"))


def test_files_without_a_header(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(HEAD + "1,A,1,10-01-2010 10:00,1.0,1\n")
    (tmp_path / "in" / "none.csv").write_text("3,C,1,12-01-2010 10:00,1.0,3\n4,C,1,12-01-2010 10:00,1.0,3\n")
    with pytest.raises(ValueError, match="none.csv"):  # beside one layout
        T.scan_raw(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "b.csv").write_text("CustomerID,Price,InvoiceDate,Quantity,StockCode,Invoice\n2,1.5,11-01-2010 10:00,3,B,2\n")
    with pytest.raises(ValueError, match="none.csv"):  # beside two
        T.scan_raw(spark, str(tmp_path / "in"))
    store, bad, state = (str(tmp_path / n) for n in ("store", "bad", "state"))
    stream_transactions(spark, str(tmp_path / "in"), store, bad, state).awaitTermination()
    assert [r["Invoice"] for r in rows_of(S.read_curated(spark, store), "Invoice")] == ["1", "2"]
    lost = spark.read.parquet(bad).collect()
    assert sorted((r.cells[0], r.reason, r.file.rsplit("/", 1)[-1]) for r in lost) == [("3", "no_header", "none.csv"), ("4", "no_header", "none.csv")]
    (tmp_path / "in" / "none2.csv").write_text("5,C,1,12-01-2010 10:00,1.0,3\n")
    stream_transactions(spark, str(tmp_path / "in"), store, bad, state).awaitTermination()  # nothing but such a file
    assert spark.read.option("mergeSchema", True).parquet(bad).where("reason = 'no_header'").count() == 3


def test_clean(spark, drops):
    clean = T.clean_transactions(T.scan_transactions(spark, str(drops / "in")))
    assert sorted(r.Invoice for r in clean.collect()) == ["100", "101", "200"]


def test_extra_columns_take_part_in_row_identity(lines):
    tx = lines([("1", "A", 1, "2010-01-01 10:00", 1.0, 1)] * 2)
    marked = tx.withColumn("Country", F.when(F.rand(1) >= 0, F.lit("X")))
    assert T.clean_transactions(marked).count() == 1
    assert T.clean_transactions(tx.withColumn("n", F.monotonically_increasing_id())).count() == 2


def test_curated_store(spark, drops):
    store = str(drops / "store")
    assert S.read_curated(spark, store).isEmpty() and S.first_sales(spark, store).isEmpty() and S.monthly_volumes(spark, store).isEmpty()
    assert S.compact_curated(spark, store) == [] and S.drop_superseded(spark, store) == 0
    clean = T.clean_transactions(T.scan_transactions(spark, str(drops / "in")))
    S.update_curated(spark, store, clean)
    S.update_curated(spark, store, clean.where("Invoice = '200'"))  # nothing new: nothing is written
    assert S.read_curated(spark, store).count() == 3 and S.read_curated(spark, store).columns == clean.columns
    before = [(x.invoice_month, x.load) for x in S.live_loads(spark, store)]
    assert [m for m, _ in before] == ["first_sales", "m2010-01", "m2010-02"]
    assert S.update_curated(spark, store, clean.where("Invoice = '200'").withColumn("Invoice", F.lit("201"))) == ["m2010-02"]
    after = [(x.invoice_month, x.load) for x in S.live_loads(spark, store)]
    assert set(before) < set(after) and {m for m, _ in set(after) - set(before)} == {"first_sales", "m2010-02"}
    assert S.read_curated(spark, store).count() == 4
    assert S.read_curated(spark, store, since="2010-02-01").count() == 2 and S.read_curated(spark, store, before="2010-02-01").count() == 2


def size_of(folder) -> int:
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def many(spark, n, start="2010-01-01"):
    when = F.expr(f"cast('{start}' as timestamp_ntz) + make_interval(0, 0, 0, cast(id % 59 as int), 0, 0, id % 3600)")
    return spark.range(n).select(
        F.concat(F.lit("i"), F.col("id") % 977).alias("Invoice"), F.col("id").cast("string").alias("StockCode"), (F.col("id") % 7 - 1).cast("double").alias("Quantity"),
        when.alias("InvoiceDate"), (F.col("id") % 100 / 8).alias("Price"), (F.col("id") % 501).alias("CustomerID"),
    )


def test_a_late_line_costs_a_small_file_and_volumes_follow(spark, lines, tmp_path):
    from tidemark.operators.quality import monthly_volume

    store = str(tmp_path / "store")

    def holds():
        got = S.read_curated(spark, store)
        volumes = lambda df: [tuple(r.values()) for r in rows_of(df.select("month", "tx_count", "customer_count", "revenue"), "month")]
        assert volumes(S.monthly_volumes(spark, store)) == volumes(monthly_volume(got))
        sales = {r.CustomerID: r.first for r in got.where("Quantity > 0").groupBy("CustomerID").agg(F.min("InvoiceDate").alias("first")).collect()}
        assert {r.CustomerID: r.first_sale for r in S.first_sales(spark, store).collect()} == sales
        cut = "2010-01-20"
        assert {r.CustomerID for r in S.first_sales(spark, store, before=cut).collect()} == {c for c, t in sales.items() if t < datetime.fromisoformat(cut)}
        return sorted(map(tuple, got.collect()))

    S.update_curated(spark, store, many(spark, 20_000))
    first, bytes_ = holds(), size_of(tmp_path / "store" / "lines")
    late = [("i1", "late", 1, "2009-12-01 10:00", 1.0, 3), ("i1", "late", 1, "2010-01-05 10:00", 1.0, 9000), ("new", "late", -1, "2010-01-05 10:00", 1.0, 9000)]
    for row in late:
        S.update_curated(spark, store, lines([row]))
    assert size_of(tmp_path / "store" / "lines") - bytes_ < 15_000 < bytes_
    second = holds()
    assert len(second) == len(first) + 3
    reader = S.read_curated(spark, store)
    assert S.compact_curated(spark, store, max_deltas=2) == ["first_sales", "m2010-01"]
    S.update_curated(spark, store, lines([("i2", "later", 1, "2010-01-05 10:00", 1.0, 9001)]))
    assert sorted(map(tuple, reader.collect())) == second  # a reader keeps the version that it began with
    third = holds()
    assert len(third) == len(second) + 1
    assert S.drop_superseded(spark, store) > 3 and holds() == third
    assert S.update_curated(spark, store, many(spark, 20_000)) and holds() == third  # a replay adds nothing
    S.compact_curated(spark, store, max_deltas=1)
    assert holds() == third


def test_appended_lines(spark, lines, tmp_path):
    store = str(tmp_path / "store")
    S.update_curated(spark, store, many(spark, 500))
    batch = lines([("x", "a", 1, "2010-01-05 10:00", 1.0, 7), ("y", "a", 1, "2011-01-05 10:00", 1.0, 9002)])
    for _ in range(2):  # a batch that is added again changes nothing
        S.append_curated(spark, store, batch, "stream 7")
    assert S.read_curated(spark, store).count() == 502
    wanted = rows_of(S.monthly_volumes(spark, store), "month")
    assert len(wanted) == 3 or len(wanted) == 4
    assert len(S.compact_curated(spark, store)) == 2  # the two months that were not counted
    assert rows_of(S.monthly_volumes(spark, store), "month") == wanted and S.read_curated(spark, store).count() == 502


def test_a_failed_merge_shows_nothing(spark, lines, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    S.update_curated(spark, store, many(spark, 100))
    before = sorted(map(tuple, S.read_curated(spark, store).collect()))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(S, "_commit", fails)
        with pytest.raises(RuntimeError):
            S.update_curated(spark, store, lines([("x", "a", 1, "2010-01-05 10:00", 1.0, 7)]))
        with pytest.raises(RuntimeError):
            S.compact_curated(spark, store, max_deltas=1)
    assert sorted(map(tuple, S.read_curated(spark, store).collect())) == before
    S.update_curated(spark, store, lines([("x", "a", 1, "2010-01-05 10:00", 1.0, 7)]))
    assert S.read_curated(spark, store).count() == 101


def test_past_months_are_not_read(spark, tmp_path):
    """Features of a window, volumes, and a merge into another month read no file of the months before."""
    import shutil

    from tidemark.plans.workspace import Workspace

    ws = Workspace(str(tmp_path))
    S.update_curated(spark, ws.path("curated"), many(spark, 1000, "2010-01-01"))
    S.update_curated(spark, ws.path("curated"), many(spark, 1000, "2010-06-01"))
    calendar = spark.sql("select timestamp_ntz'2010-06-01' as feature_start")
    window, earlier = ws.feature_inputs(spark, calendar)
    assert window.count() == 1000 and earlier.count() == S.first_sales(spark, ws.path("curated"), before="2010-06-01").count() > 400
    read = "\n".join(df.inputFiles()[0] for df in (window,)) + str(window.inputFiles()) + str(earlier.inputFiles())
    assert "m2010-01" not in read and "m2010-02" not in read
    for month in ("m2010-01", "m2010-02"):
        shutil.copytree(tmp_path / "curated" / "lines" / f"invoice_month={month}", tmp_path / "kept" / month)
        for f in (tmp_path / "curated" / "lines" / f"invoice_month={month}").rglob("*.parquet"):
            f.write_bytes(b"unreadable")
    assert S.monthly_volumes(spark, ws.path("curated")).count() == 4
    S.update_curated(spark, ws.path("curated"), many(spark, 1100, "2010-06-01"))
    assert S.read_curated(spark, ws.path("curated"), since="2010-06-01").count() == 1100


def test_store_keeps_lines_without_a_time_and_new_columns(spark, lines, tmp_path):
    store = str(tmp_path / "store")
    untimed = lambda i: lines([(i, "A", 1, "2010-01-01 10:00", 1.0, 1)]).withColumn("InvoiceDate", F.lit(None).cast("timestamp_ntz"))
    timed = lambda i: lines([(i, "A", 1, "2010-01-01 10:00", 1.0, 1)])
    S.update_curated(spark, store, untimed("1").unionByName(timed("2")))
    S.update_curated(spark, store, untimed("3").unionByName(timed("4")).withColumn("Country", F.lit("UK")))
    got = {r.Invoice: r.Country for r in S.read_curated(spark, store).collect()}
    assert got == {"1": None, "2": None, "3": "UK", "4": "UK"}


def test_point_in_time_union(lines):
    a = lines([("1", "A", 1, "2010-01-01 10:00", 1.0, 1), ("2", "A", 1, "2010-03-01 10:00", 1.0, 1)])
    b = lines([("3", "A", 1, "2010-02-01 10:00", 1.0, 1)])
    cut = F.lit("2010-03-01").cast("timestamp_ntz")
    assert sorted(r.Invoice for r in T.point_in_time_union(a, b, cut).collect()) == ["1", "3"]
    T.require_disjoint(a, b, cut)
    with pytest.raises(ValueError):
        T.require_disjoint(a, b)


def test_history_evolves(spark, tmp_path):
    path = str(tmp_path / "history")
    assert history.read_history(spark, path) is None
    old = spark.createDataFrame([("2020-01-01", 0.75)], "snapshot_date string, roc_auc double")
    new = spark.createDataFrame([("2020-02-01", 0.76, 0.2)], "snapshot_date string, roc_auc double, brier_score double")
    for df in (old, new):
        history.append_history(df, path)
    for got in (history.evolve(old, new), history.read_history(spark, path)):
        rows = rows_of(got, "snapshot_date")
        assert got.columns == ["snapshot_date", "roc_auc", "brier_score"]
        assert [r["brier_score"] for r in rows] == [None, 0.2]


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "manifest")
    assert history.read_manifest(spark, path).isEmpty()
    record = spark.createDataFrame([("SUCCESS", "abc", "2020-02-01")], "status string, sha256 string, snapshot_date string")
    history.append_manifest(record, path)
    history.append_manifest(record.withColumn("recorded_at", F.lit("2020-01-01")), path)
    rows = rows_of(history.read_manifest(spark, path), "recorded_at")
    assert [r["sha256"] for r in rows] == ["abc", "abc"] and rows[0]["recorded_at"] == "2020-01-01" and rows[1]["recorded_at"]


def test_file_inventory(spark, drops):
    import hashlib

    got = {r.source_file.rsplit("/", 1)[-1]: r for r in history.file_inventory(spark, str(drops / "in"), "*.csv").collect()}
    text = (HEAD + JAN).splitlines()
    total = sum(int(hashlib.sha256(x.encode()).hexdigest()[:15], 16) for x in text)
    assert set(got) == {"jan.csv"} and got["jan.csv"].bytes == len(HEAD + JAN) and got["jan.csv"].lines == len(text)
    assert got["jan.csv"].sha256 == hashlib.sha256(f"{len(text)}:{total}".encode()).hexdigest()


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame(
        [("2020-01-01", "official", "v1", 1, 0.5), ("2020-01-01", "shadow", "v0", 1, 0.4)],
        "snapshot_date string, prediction_role string, model_version string, CustomerID long, churn_probability double",
    ).withColumn("snapshot_date", F.to_date("snapshot_date"))
    path = str(tmp_path / "predictions")
    history.write_predictions(df, path)
    history.write_predictions(df.where("prediction_role = 'official'").withColumn("churn_probability", F.lit(0.9)), path)
    assert {r.prediction_role: r.churn_probability for r in spark.read.parquet(path).collect()} == {"official": 0.9, "shadow": 0.4}
    runs = str(tmp_path / "runs")
    for execution in ("20200101T000000Z-a", "20200102T000000Z-b"):
        history.write_execution(df, runs, execution)
    history.write_execution(df, runs, "20200102T000000Z-b")
    history.write_feature_snapshot(df, str(tmp_path / "features"))
    history.write_feature_snapshot(df, str(tmp_path / "features"))
    assert spark.read.parquet(runs).select("execution_id").distinct().count() == 2
    assert spark.read.parquet(runs).count() == 4 and spark.read.parquet(str(tmp_path / "features")).count() == 2  # reruns replace
    for fmt in ("csv", "json", "parquet"):
        history.write_report(df, str(tmp_path / fmt), fmt)
    history.log_run(df.limit(1), str(tmp_path / "log"))
    assert "timestamp" in spark.read.json(str(tmp_path / "log")).columns
    with pytest.raises(ValueError):
        history.write_report(df, str(tmp_path / "x"), "xml")


def test_lines_of_any_width_keep_their_cells(spark, tmp_path):
    """Only six cells have places; longer and shorter lines are as if every cell had one."""
    wide = HEAD.strip() + ",Note,More\n"
    body = '1,A,1,10-01-2010 10:00,1.0,1\n\n\n2,"a, ""b""",1,11-01-2010 10:00,1.0,2,"two\r\nlines, ""x""",m,beyond\n3,C,1,12-01-2010 10:00\n 4 ,D,1,13-01-2010 10:00,1.0,4,,last\n'
    (tmp_path / "w.csv").write_text("Note only\n" + wide + body, newline="")
    (tmp_path / "n.csv").write_text(HEAD + body, newline="")
    schema = ", ".join(f"c{i} string" for i in range(9))
    seen = spark.read.schema(schema).options(escape='"', multiLine=True).csv(str(tmp_path / "w.csv")).collect()
    want = sorted(tuple(r)[:8] for r in seen if r.c0 != "Invoice")
    got = T.scan_raw(spark, str(tmp_path / "w.csv")).select(*T.REQUIRED, "Note", "More").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and len(got) == 5
    both = T.scan_raw(spark, str(tmp_path)).select(*T.REQUIRED, "Note", "More").collect()
    assert len(both) == 9 and sum(r.Note is not None for r in both) == 1 and sum(r.More == "last" for r in both) == 1


def test_a_batch_is_parsed_once(spark, drops, monkeypatch):
    """The passes of a micro-batch read a stored table, not the files again."""
    from tidemark.streaming import ingest

    kept = []
    monkeypatch.setattr(ingest, "written", lambda df, label: kept.append(label) or T.written(df, label))
    stream_transactions(spark, str(drops / "in"), *(str(drops / n) for n in ("store", "bad", "state"))).awaitTermination()
    assert kept[0] == "stream-cells" and kept.count("stream-cells") == 1


def test_streaming_load(spark, drops):
    store, bad, state = (str(drops / n) for n in ("store", "bad", "state"))
    run = lambda: stream_transactions(spark, str(drops / "in"), store, bad, state, "2010-01-05").awaitTermination()
    run()
    first = rows_of(S.read_curated(spark, store), "Invoice")
    assert [r["Invoice"] for r in first] == ["100", "101", "200"]
    run()  # nothing new: nothing changes
    assert rows_of(S.read_curated(spark, store), "Invoice") == first
    (drops / "in" / "more.csv").write_text(HEAD + FEB + "201,A,1,03-02-2010 08:00,1.0,3\n202,A,x,03-02-2010 08:00,1.0,3\n203,A,1,nonsense,1.0,3\n204,A,1,31-12-2009 08:00,1.0,3\n")
    run()
    assert [r["Invoice"] for r in rows_of(S.read_curated(spark, store), "Invoice")] == ["100", "101", "200", "201"]
    reasons = {r.Invoice: r.reason for r in spark.read.parquet(bad).collect()}
    assert reasons == {"202": "bad_quantity", "203": "bad_time", "204": "late"}


def test_stream_drops_copies_by_state(spark, drops, monkeypatch):
    store, bad, state = (str(drops / n) for n in ("store", "bad", "state"))

    def run(**options):
        stream_deduplicated(spark, str(drops / "in"), store, bad, state, delay="30 days", **options).awaitTermination()
        return [(r["Invoice"], r["StockCode"]) for r in rows_of(S.read_curated(spark, store), "Invoice", "StockCode")]

    def unread(*_args, **_options):
        raise AssertionError("the store was read")

    first = [("100", "A"), ("101", "B"), ("200", "A")]
    with monkeypatch.context() as m:
        m.setattr(S, "_lines", unread)
        stream_deduplicated(spark, str(drops / "in"), store, bad, state, delay="30 days").awaitTermination()
    assert run() == first  # nothing new: nothing changes, on the same checkpoint
    # Copies, in another column order, beside new lines; one of each behind the watermark (2 January).
    more = "CustomerID,Price,InvoiceDate,Quantity,StockCode,Invoice,Country\n1,10.0,01-02-2010 00:00,-1,A,200,\n17850.0,2.5,31-01-2010 23:59,1,B,101,\n3,1.0,03-02-2010 08:00,1,A,201,UK\n"
    late = "4,1.0,02-01-2010 00:00,1,A,90,\n4,1.0,02-01-2010 00:01,1,A,91,\n4,1.0,01-01-1970 00:00,1,A,92,\n4,x,02-02-2010 00:01,1,A,93,\n"
    (drops / "in" / "more.csv").write_text(more + late)
    want = sorted([*first, ("201", "A"), ("91", "A")])
    assert run() == want
    (drops / "in" / "more2.csv").write_text(HEAD + JAN + FEB + "202,A,1,01-03-2010 08:00,1.0,3\n")
    assert run() == sorted([*want, ("202", "A")])
    reasons = sorted((r.Invoice, r.reason) for r in spark.read.parquet(bad).collect())
    assert reasons == [("90", "behind_watermark"), ("92", "behind_watermark"), ("93", "bad_price")]
    assert {r.Invoice: r.Country for r in S.read_curated(spark, store).collect()}["201"] == "UK"
    S.compact_curated(spark, store)
    assert sum(r.tx_count for r in S.monthly_volumes(spark, store).collect()) == 6


def test_loaded_files_do_not_pile_up(spark, drops):
    """Landed files go with the batch that loaded them, delivered ones only when asked; copies are still known."""
    store, bad, state = (str(drops / n) for n in ("store", "bad", "state"))

    def run(**options):
        stream_deduplicated(spark, str(drops / "in"), store, bad, state, delay="3650 days", **options).awaitTermination()
        return sorted((r.Invoice, r.StockCode) for r in S.read_curated(spark, store).collect())

    first = [("100", "A"), ("101", "B"), ("200", "A")]
    names = lambda: sorted(p.name for p in (drops / "in").rglob("*"))
    delivered = names()
    assert run() == first and names() == delivered
    (drops / "in" / "again and + more.csv").write_text(HEAD + JAN + FEB + "202,A,1,01-03-2010 08:00,1.0,3\n")
    want = sorted([*first, ("202", "A")])
    assert run(keep_drops=False) == want
    assert names() == delivered  # what an earlier run has read stays
    (drops / "in" / "later.csv").write_text(HEAD + JAN + FEB)
    assert run(keep_drops=False) == want  # by the state, as nothing else is left
    landed = [r.Invoice for r in spark.read.parquet(f"{state}/landing").collect()]
    assert "202" not in landed


def test_metadata_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('{\n "version": "v1", "threshold": 0.4, "extra": {"x": [1]},\n "test_metrics": {"roc_auc": 0.8, "recall": NaN, "other": "t"}\n}')
    (tmp_path / "b.json").write_text('[{"version": "v2", "metrics": {}}, {"version": "v3", "snapshot_date": "2020-01-31"}]')
    (tmp_path / "notes.txt").write_text("no JSON")
    got = {r.version: r for r in history.read_metadata(spark, str(tmp_path), lines=False).collect()}
    assert got["v1"].test_metrics.roc_auc == 0.8 and got["v1"].test_metrics.recall is None and got["v1"].metrics is None and got["v1"].threshold == 0.4
    assert got["v2"].metrics.roc_auc is None and str(got["v3"].snapshot_date) == "2020-01-31" and len(got) == 3
    (tmp_path / "c.json").write_text('{"version": ')
    with pytest.raises(Exception):
        history.read_metadata(spark, str(tmp_path), lines=False).collect()
