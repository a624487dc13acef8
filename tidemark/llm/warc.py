"""A deterministic sharded WARC writer, and a reader that checks what it reads.

Pages are dealt into shards of even size by ranges of their id, and of a hash of the payload where one id has more pages
than a shard holds. The bounds come from exact byte counts of ranges that are split where they reach over the end of a shard;
pages are sorted inside a shard. Each shard is written as gzip members to files that roll at a compressed size. A file is written under
a temporary name, moved to its final name when it is whole, and listed in a manifest which is committed last; readers
open nothing but what the manifest lists. Names, headers, dates and digests depend on the pages alone, so a repeated
task writes the same bytes again.

Of records with equal payloads of ``revisit_bytes`` or more the one with the smallest page_id is a response and the
others revisit it. Which page that is travels to the writer as small rows of the same sorted stream, so the payloads
are shuffled once, and equal payloads meet only as digests.

Defined results: null html is an empty payload; a null url becomes ``urn:page:<id>``; pages with a null id come first,
are always responses, and are read back with a null id; of rows that repeat an id and a payload of that size the first
is the response and the others revisit it, for which all rows of one id and payload share a shard; extra columns are ignored; an empty table writes an empty manifest.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.common import new_path, stored, table

SHARD_BYTES = 32 << 20  # of payload; larger where there would be more than MAX_SHARDS
MAX_SHARDS = 10_000
BITS = 6  # of a place, by which a range of places is split at a time
ROLL_BYTES = 16 << 20  # of a compressed file
READERS = 10_000  # tasks that read archives at most
REVISIT_BYTES = 100
DATE = "2020-01-01T00:00:00Z"

_MANIFEST = "shard long, seq int, name string, records long, bytes long, sha256 string"
_RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, file string"


def _record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + ':'.join(map(str, parts)))}>"


def _clean(url: str | None, page_id) -> str:
    """A header value of one line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + f"Content-Length: {len(block)}\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def _page_record(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + b"Content-Length: %d\r\n\r\n" % len(payload) + (payload if refers_to is None else b"")
    headers = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(page_id, url, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _clean(url, page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", "sha256:" + hashlib.sha256(block).hexdigest()),
        ("WARC-Payload-Digest", "sha256:" + digest),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        headers.append(("X-Page-Id", str(page_id)))
    if refers_to is not None:
        headers += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Refers-To-Page", str(refers_to))]
    return _member(headers, block)


class _Files:
    """The files of one shard after another, each whole before it gets its name."""

    def __init__(self, root: str, roll: int, date: str):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(root)
        self.attempt, self.roll, self.date, self.out = TaskContext.get().taskAttemptId(), roll, date, None
        self.shard, self.seq = None, 0

    def add(self, shard: int, member: bytes):
        done = self.close() if self.out and (shard != self.shard or self.size + len(member) > self.roll) else None
        if not self.out:
            self.seq = self.seq + 1 if shard == self.shard else 0
            self.shard, self.size, self.records, self.sha = shard, 0, 0, hashlib.sha256()
            self.name = f"part-{shard:06d}-{self.seq:05d}.warc.gz"
            self.temporary = f"{self.root}/_temporary-{self.name}-{self.attempt}-{uuid.uuid4().hex}"
            self.out = self.fs.open_output_stream(self.temporary, compression=None)
            self._put(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id("info", self.name)), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._put(member)
        self.records += 1
        return done

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self):
        if not self.out:
            return None
        self.out.close()
        self.out = None
        self.fs.move(self.temporary, f"{self.root}/{self.name}")
        return (self.shard, self.seq, self.name, self.records, self.size, self.sha.hexdigest())


def _manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = ["shard", "seq", "name", "records", "bytes", "sha256"], [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)


def _split(rows: DataFrame, shard_bytes: int) -> tuple[int, list[DataFrame]]:
    """How the shard of a row follows from its place: the number of shards, and a table for each level of the search.

    ``rows (place_id, place_sub, size)`` are ordered by the two places. A node is a range of places with the same leading bits. While
    it reaches over the end of a shard and is not small it is split by its next differing bits, the hash of the payload
    following the id; each round counts the bytes of the children exactly. A shard is then a range of bytes of that order. A
    round splits one node for each end of a shard at most, so a level has no more than 2^BITS times MAX_SHARDS rows.
    """
    whole = rows.agg(F.min("place_id").alias("lo"), F.max("place_id").alias("hi"), F.min("place_sub").alias("lo_sub"), F.max("place_sub").alias("hi_sub"), F.sum("size").alias("size")).first()
    if whole.lo is None or whole.size <= shard_bytes:
        return 1, []
    shard_bytes = max(shard_bytes, whole.size // MAX_SHARDS)
    by_id = whole.lo != whole.hi
    ends = (whole.lo, whole.hi) if by_id else (whole.lo_sub, whole.hi_sub)
    root = rows.sparkSession.createDataFrame([(0, int(not by_id), max(((ends[0] ^ ends[1]) & (1 << 64) - 1).bit_length() - BITS, 0))], "base long, word int, shift int")
    levels = [root]
    shard = lambda x: F.floor(x / F.lit(shard_bytes)).cast("long")
    shift = lambda lo, hi: F.greatest(F.length(F.bin(F.col(lo).bitwiseXOR(F.col(hi)))) - BITS, F.lit(0)).cast("int")
    while True:
        kids = _descend(rows, levels).where("shard is null").groupBy("base", *_NODE).agg(
            F.min("place_id").alias("lo"), F.max("place_id").alias("hi"), F.min("place_sub").alias("lo_sub"), F.max("place_sub").alias("hi_sub"), F.sum("size").alias("size")
        )
        siblings = Window.partitionBy("base").orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        kids = kids.withColumn("before", F.col("base") + F.sum("size").over(siblings) - F.col("size"))
        crosses = shard(F.col("before")) != shard(F.col("before") + F.col("size") - 1)
        done = ~crosses | (F.col("size") * 16 <= shard_bytes) | ((F.col("lo") == F.col("hi")) & (F.col("lo_sub") == F.col("hi_sub")))
        kids = kids.select(
            *_NODE,
            F.when(done, shard(F.col("before"))).alias("found"),
            F.when(~done, F.col("before")).alias("next_base"),
            F.when(~done, (F.col("lo") == F.col("hi")).cast("int")).alias("next_word"),
            F.when(~done, F.when(F.col("lo") == F.col("hi"), shift("lo_sub", "hi_sub")).otherwise(shift("lo", "hi"))).alias("next_shift"),
        )
        levels.append(stored(kids, "warc-level"))
        if levels[-1].where("found is null").isEmpty():
            return whole.size // shard_bytes + 1, levels


_NODE = ["word", "shift", "of", "prefix"]


def _descend(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``rows`` with the ``shard`` found at one of the levels, or with the node (``base``, ``word``, ``shift``, ``of``, ``prefix``) that is still to be split."""
    start = levels[0].first()
    state = {"base": F.lit(start.base).cast("long"), "word": F.lit(start.word), "shift": F.lit(start.shift), "shard": F.lit(None).cast("long")}
    out = rows.withColumns(state)
    # The sign bit is turned so that the order of signed places is that of their bits. A node of payloads belongs to one id.
    node = {
        "of": F.when(F.col("word") == 1, F.col("place_id")).otherwise(F.lit(0).cast("long")),
        "prefix": F.expr(f"shiftrightunsigned((CASE WHEN word = 1 THEN place_sub ELSE place_id END) ^ {_SIGN}, shift)"),
    }
    for level in levels[1:]:
        out = out.withColumns(node).join(F.broadcast(level), _NODE, "left").withColumn("shard", F.coalesce("shard", "found"))
        out = out.drop("base", *_NODE, "found").withColumnsRenamed({"next_base": "base", "next_word": "word", "next_shift": "shift"})
    return out.withColumns(node)


_SIGN = "shiftleft(1L, 63)"


def _sharded(rows: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``rows (place_id, place_sub, ...)`` with their ``shard`` in place of the places."""
    if not levels:
        return rows.withColumn("shard", F.lit(0).cast("long")).drop("place_id", "place_sub")
    return _descend(rows, levels).drop("place_id", "place_sub", "base", *_NODE)


def write_archives(pages: DataFrame, root: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES, revisit_bytes: int = REVISIT_BYTES, date: str = DATE) -> DataFrame:
    """Write ``pages (page_id, url, html)`` below ``root`` and return the committed manifest."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("html"))
    place_id = F.coalesce(F.col("page_id"), F.lit(-(1 << 63))).alias("place_id")
    # One pass over the payloads tells sizes and digests; all that follows, but for the writing, reads this table.
    known = stored(
        rows.select("page_id", place_id, F.xxhash64("html").alias("place_sub"), (F.octet_length("html") + F.lit(600)).cast("long").alias("size"), F.unhex(F.sha2(F.col("html").cast("binary"), 256)).alias("digest")),
        "warc-known",
    )
    digests = known.where(F.col("size") >= revisit_bytes + 600)
    firsts = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null").drop("n")
    later = digests.join(firsts, "digest").where("page_id is not null").select("page_id", "place_id", "place_sub", F.lower(F.hex("digest")).alias("digest"), "refers_to").distinct()

    count, levels = _split(known.select("place_id", "place_sub", "size"), shard_bytes)
    # The small rows need no bytes of their own: their shard is that of the page, found the same way.
    none = lambda kind: F.lit(None).cast(kind)
    stream = _sharded(rows.select("*", place_id, F.xxhash64("html").alias("place_sub")), levels).select(
        "shard", "page_id", F.lit(1).alias("kind"), "url", "html", none("string").alias("digest"), none("long").alias("refers_to")
    )
    notes = _sharded(later, levels).select("shard", "page_id", F.lit(0).alias("kind"), none("string").alias("url"), none("string").alias("html"), "digest", "refers_to")
    dealt = stream.unionByName(notes).repartitionById(count, F.col("shard").cast("int"))
    dealt = dealt.sortWithinPartitions(F.col("shard"), F.col("page_id").asc_nulls_first(), "kind", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known, at = _Files(root, roll_bytes, date), {}, object()
        for batch in batches:
            for row in range(batch.num_rows):
                shard, page_id, kind, url, html, digest, refers_to = (batch.column(c)[row].as_py() for c in range(7))
                if page_id != at:
                    at, known = page_id, {}
                if kind == 0:
                    known[digest] = refers_to
                    continue
                body = html.encode()
                digest = hashlib.sha256(body).hexdigest()
                first = known.get(digest)
                if first == page_id:  # the response itself; a repeated row revisits it
                    known[digest], first = (page_id,), None
                elif isinstance(first, tuple):
                    first = page_id
                done = files.add(shard, _page_record(page_id, url, body, digest, first, date))
                if done:
                    yield _manifest_batch([done])
        done = files.close()
        if done:
            yield _manifest_batch([done])

    _make(root)
    dealt.mapInArrow(run, _MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def _make(root: str) -> None:
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(root)
    where.create_dir(path, recursive=True)


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of gzip members; holds one record at a time."""
    buffer, unpack = b"", zlib.decompressobj(31)
    member = []
    while True:
        if not buffer:
            buffer = stream.read(1 << 20)
            if not buffer:
                if member:
                    raise ValueError("the archive ends inside a record")
                return
        member.append(unpack.decompress(buffer))
        buffer = b""
        if unpack.eof:
            buffer = unpack.unused_data
            head, _, rest = b"".join(member).partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            headers = dict(line.split(": ", 1) for line in lines[1:])
            size = int(headers["Content-Length"])
            if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
                raise ValueError("a record does not have the length it states")
            yield headers, rest[:size]
            member, unpack = [], zlib.decompressobj(31)


def read_archives(manifest: DataFrame, root: str, payloads: bool = True) -> DataFrame:
    """The page records of the files that the manifest lists; block and payload digests are checked on the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(root)
        names = [c.split()[0] for c in _RECORD.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        for batch in batches:
            for name, records in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows, held, seen = [], 0, 0
                with where.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for headers, block in _records(stream):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        seen += 1
                        body = block.partition(b"\r\n\r\n")[2]
                        digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
                        if headers["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
                            raise ValueError(f"{name}: a block does not match its digest")
                        if headers["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
                            raise ValueError(f"{name}: a payload does not match its digest")
                        page, refers = headers.get("X-Page-Id"), headers.get("X-Refers-To-Page")
                        rows.append((page and int(page), headers["WARC-Target-URI"], body if payloads and refers is None else None, int(headers["X-Payload-Length"]), digest, headers["WARC-Type"], refers and int(refers), name))
                        held += len(body) if payloads else 200
                        if held > 4 << 20:
                            yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                if seen != records:
                    raise ValueError(f"{name}: {seen} records, the manifest states {records}")
                if rows:
                    yield pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names=names)

    files = manifest.select("name", "records")
    return files.repartition(max(1, min(files.count(), READERS)), "name").mapInArrow(run, _RECORD)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), root)
    return read_archives(manifest, root, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
"""
