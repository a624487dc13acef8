"""Session settings and the shared scratch location."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, app: str = "tidemark", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Repeated queries keep their compiled code.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # Small inputs still use every core of one machine.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and working tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may fall back to a fresh
    temporary folder, one per application, since no other machine has to read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = tempfile.mkdtemp(prefix="tidemark-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _FALLBACK[app]


#: Bytes of stored input for which a shuffle gets a partition, shuffled bytes that adaptive execution may join into one, and
#: stored bytes that a task reads: with many partitions it sorts all its rows for the shuffle.
INPUT_BYTES, TASK_BYTES, SCAN_BYTES = 3 << 20, 4 << 20, 16 << 20


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgt]?)i?b?\s*", text.lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def sized(spark: SparkSession, *paths: str) -> None:
    """Let the session's shuffles have as many partitions as the stored input asks for, so that a task's memory does not grow with it.

    Settings are only ever tightened: a larger number of partitions or a smaller size of joined or read ones stays.
    """
    size = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    if int(spark.conf.get("spark.sql.shuffle.partitions")) < size // INPUT_BYTES:
        spark.conf.set("spark.sql.shuffle.partitions", str(size // INPUT_BYTES))
    limits = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": TASK_BYTES, "spark.sql.files.maxPartitionBytes": SCAN_BYTES}
    for name, limit in limits.items():
        if _bytes(spark.conf.get(name)) > limit:
            spark.conf.set(name, str(limit))


_OWNED: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage, whatever file system holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession):
    """Owner of the working tables made inside: they are deleted at its end, so no result may still read them."""
    paths: list[str] = []
    _OWNED.append(paths)
    try:
        yield
    finally:
        _OWNED[:] = [x for x in _OWNED if x is not paths]
        for path in paths:
            delete(spark, path)


def owns_scratch(plan):
    """A plan (its first argument is the session) that deletes its working tables when it ends or fails."""

    @functools.wraps(plan)
    def run(spark: SparkSession, *args, **options):
        with scratch(spark):
            return plan(spark, *args, **options)

    return run


def small(df: DataFrame) -> DataFrame:
    """A result of a few rows, freed from the tables it was computed from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def written(df: DataFrame, label: str = "table", **options) -> DataFrame:
    """``df`` written once as a columnar table in the shared folder and read back.

    For an intermediate result that several branches read: each branch scans only its columns, and
    a lost executor costs a re-read. Inside ``scratch`` the folder goes with it; else it is the caller's to expire.
    ``options`` are those of the writer.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
