"""Transaction sources: CSV drops, cleaning, and the point-in-time union of two feeds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import written

# Fixed value: the timestamp layout of the CSV feeds.
CSV_TIME_FORMAT = "dd-MM-yyyy HH:mm"

REQUIRED = ("Invoice", "StockCode", "Quantity", "InvoiceDate", "Price", "CustomerID")

TRANSACTIONS = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Quantity", T.DoubleType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("Price", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
    ]
)

# Columns a CSV file may have; one with more is refused. Cells are read by place as text; names come from each file's
# own header.
MAX_COLUMNS = 64
#
# Only the first ``FEW`` cells have places of their own: the parser raises and catches an error at every place that a line
# does not have. A line with another number of cells comes with its text, from which wider files take their cells.
FEW = len(REQUIRED)
_CELLS = [f"cell_{i}" for i in range(MAX_COLUMNS + 1)]
_BY_PLACE = T.StructType([T.StructField(c, T.StringType()) for c in (*_CELLS[:FEW], "raw")])
# Cells are quoted as spreadsheets write them: quotes inside are doubled, and a line may break inside a cell.
_QUOTING = {"escape": '"', "multiLine": "true"}


def is_missing(e: AnalysisException) -> bool:
    """The table has not been written yet."""
    return any(s in str(e) for s in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def cell_reader(reader):
    """Options shared by the batch and the streaming CSV reader.

    The files of a folder tree are found recursively, whatever the case of the suffix.
    """
    return (
        reader.schema(_BY_PLACE)
        .option("header", False)
        .option("columnNameOfCorruptRecord", "raw")
        # A file is then read from its start by one task; a feed spreads over its files.
        .options(**_QUOTING)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
    )


def with_origin(cells: DataFrame) -> DataFrame:
    """``file``, the first ``cells``, ``raw`` for lines with more or fewer, and ``header``: the names, if the line is one.

    A header can only be in the part of a file that starts at its first byte.
    """
    start = (F.col("_metadata.file_block_start") == 0).alias("from_start")
    lines = cells.select(F.col("_metadata.file_path").alias("file"), start, F.array(*_CELLS[:FEW]).alias("cells"), "raw")
    header = F.when(F.col("from_start") & _is_header(), _names())
    return lines.select("file", header.alias("header"), "cells", "raw")


def _split(width: int) -> Column:
    return F.from_csv("raw", F.lit(", ".join(f"{c} string" for c in _CELLS[:width])), _QUOTING)


def all_cells(lines: DataFrame, width: int = len(_CELLS)) -> DataFrame:
    """``file`` and the first ``width`` cells of each line, or fewer where it has no more."""
    if width <= FEW:
        return lines.select("file", "cells")
    found = lines.select("file", "cells", F.when(F.col("raw").isNotNull(), _split(width)).alias("split"))
    return found.select("file", F.when(F.col("split").isNull(), F.col("cells")).otherwise(F.array(*[F.col("split")[c] for c in _CELLS[:width]])).alias("cells"))


def _names() -> Column:
    """The names that a line holds, up to the last one."""
    every = F.transform(F.array(_split(len(_CELLS))), lambda x: F.array(*[x[c] for c in _CELLS]))[0]
    names = F.transform(F.when(F.col("raw").isNull(), F.col("cells")).otherwise(every), _name)
    last = F.array_max(F.transform(names, lambda x, i: F.when(x.isNotNull(), i + 1)))
    return F.slice(names, 1, F.coalesce(last, F.lit(0)))


def _is_header() -> Column:
    """A line that names at least two of the required columns. Few lines hold two of the names at all: only their cells are looked at."""
    text = F.replace(F.coalesce("raw", F.concat_ws("\n", "cells")), F.lit("\ufeff"), F.lit(""))
    held = sum(F.contains(text, F.lit(c)).cast("int") for c in REQUIRED)
    return (held >= 2) & (F.size(F.array_intersect(_names(), F.array(*[F.lit(c) for c in REQUIRED]))) >= 2)


def _name(cell: Column) -> Column:
    return F.trim(F.regexp_replace(cell, "\ufeff", ""))


def file_headers(cells: DataFrame) -> DataFrame:
    """One row a file that has lines: its name and its ``header``, null if no line of it is one."""
    return cells.select("file", "header").distinct().groupBy("file").agg(F.max("header").alias("header"))


def by_header(cells: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Text columns under the names of each file's own header, in whatever order and with whatever further columns.

    A column is present if every file has it or if it is not a required one; so ``structural_quality`` sees what is
    missing. A file without a header is refused, whatever the others have. Only the distinct headers reach the driver.
    ``files`` are the ``file_headers``, if they are known already.
    """
    files = written(file_headers(cells), "headers") if files is None else files
    found = files.groupBy("header").agg(F.min("file").alias("file"), F.count("*").alias("n")).collect()
    layouts = [r.header for r in found if r.header is not None]
    if not layouts:
        raise ValueError("no CSV files found, or none with a header")
    for r in found:
        if r.header is None:
            raise ValueError(f"{r.n} CSV files have no header, such as {r.file}")
    if any(len(x) > MAX_COLUMNS for x in layouts):
        raise ValueError(f"a CSV file has more than {MAX_COLUMNS} columns")
    known = [c for c in REQUIRED if all(c in x for x in layouts)]
    known += sorted({c for x in layouts for c in x if c and c not in REQUIRED})
    lines = all_cells(cells.where(F.col("header").isNull()), max(map(len, layouts)))
    if len(layouts) == 1:
        return lines.select(*[F.get("cells", F.lit(layouts[0].index(c))).alias(c) for c in known])
    places = F.array(*[F.array_position("header", F.lit(c)).cast("int") - 1 for c in known])
    both = lines.join(files.select("file", places.alias("places")), "file")
    return both.select(*[F.get("cells", F.get("places", F.lit(i))).alias(c) for i, c in enumerate(known)])


def scan_raw(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of one or more CSV files or folders as text. No order is imposed; no result depends on one."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no transaction files were supplied")
    return by_header(with_origin(cell_reader(spark.read).csv(paths)))


def parsed_time(strict: bool = False) -> Column:
    if strict:
        return F.to_timestamp_ntz("InvoiceDate", F.lit(CSV_TIME_FORMAT))
    return F.expr(f"cast(try_to_timestamp(InvoiceDate, '{CSV_TIME_FORMAT}') as timestamp_ntz)")


def parse_raw(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Text columns to the transaction schema.

    ``strict`` fails on a malformed time or number, as a batch load must; otherwise it becomes NULL.
    Customer ids may be written as ``17850.0``.
    """
    missing = sorted(set(REQUIRED) - set(raw.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if strict:
        number = lambda c, t: F.col(c).cast("double").cast(t)
    else:
        number = lambda c, t: F.expr(f"try_cast(try_cast({c} as double) as {t})")
    return raw.select(
        "Invoice",
        "StockCode",
        number("Quantity", "double").alias("Quantity"),
        parsed_time(strict).alias("InvoiceDate"),
        number("Price", "double").alias("Price"),
        number("CustomerID", "bigint").alias("CustomerID"),
        *[c for c in raw.columns if c not in REQUIRED],
    )


def scan_transactions(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of one or more CSV files or folders under the transaction schema, further columns as text."""
    return parse_raw(scan_raw(spark, paths))


def clean_transactions(tx: DataFrame) -> DataFrame:
    """Lines with a customer, one copy of each full row.

    Copies collapse on the map side first, so a row repeated any number of times stays cheap.
    """
    return tx.where(F.col("CustomerID").isNotNull()).dropDuplicates()


def curate(history: DataFrame, batch: DataFrame) -> DataFrame:
    """The curated store after a batch: union, one copy of each full row."""
    return history.unionByName(batch, allowMissingColumns=True).dropDuplicates()


def point_in_time_union(bootstrap: DataFrame, replay: DataFrame, as_of) -> DataFrame:
    """Both feeds cut strictly before ``as_of``. The cut reaches the scans."""
    known = F.col("InvoiceDate") < as_of
    return bootstrap.where(known).unionByName(replay.where(known), allowMissingColumns=True)


def feed_overlap(bootstrap: DataFrame, replay: DataFrame) -> DataFrame:
    """One row: last bootstrap time, first replay time, and whether the feeds overlap."""
    ends = bootstrap.agg(F.max("InvoiceDate").alias("bootstrap_max"), F.lit(None).cast("timestamp_ntz").alias("replay_min"))
    starts = replay.agg(F.lit(None).cast("timestamp_ntz").alias("bootstrap_max"), F.min("InvoiceDate").alias("replay_min"))
    return (
        ends.unionByName(starts)
        .agg(F.max("bootstrap_max").alias("bootstrap_max"), F.max("replay_min").alias("replay_min"))
        .withColumn("overlaps", F.coalesce(F.col("bootstrap_max") >= F.col("replay_min"), F.lit(False)))
    )


def require_disjoint(bootstrap: DataFrame, replay: DataFrame, as_of=None, whole_bootstrap: bool = False) -> None:
    """Refuse to double-count: every bootstrap line must precede every replay line.

    With ``as_of`` only the lines before it count. ``whole_bootstrap`` is the stricter rule of
    retraining: the bootstrap is judged uncut, and some replay line must exist.
    """
    if as_of is not None:
        known = F.col("InvoiceDate") < as_of
        replay = replay.where(known)
        bootstrap = bootstrap if whole_bootstrap else bootstrap.where(known)
    row = feed_overlap(bootstrap, replay).first()
    if whole_bootstrap and row.replay_min is None:
        raise ValueError("no replay lines before the cutoff")
    if row.overlaps:
        raise ValueError(f"feeds overlap: bootstrap ends {row.bootstrap_max}, replay starts {row.replay_min}")
