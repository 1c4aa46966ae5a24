"""Bars from many CSV files whose headers differ, with the rows that cannot be read kept aside."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.config import REQUIRED_COLUMNS
from barwatch.session import broadcast_if_small, is_small, materialize
from barwatch.sources.bars_csv import MISSING_TEXTS

NO_HEADER = "no header"
MISSING = "missing columns: "
BAD_DATE = "bad date"
BAD_NUMBER = "bad number: "
TOO_MANY = "more cells than columns"

MAX_FILES = 1_000_000
"""Files up to which what is known of each goes to all tasks: some 200 bytes, its path as a hash."""

COMMA = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'
"""A comma outside quotes."""


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All lines of the files, which are listed here, by as many tasks as shuffles have.

    Spark's own default is a task per folder, up to 10,000, and a folder is listed faster than a task starts.
    """
    usual = spark.conf.get(LISTING)
    spark.conf.set(LISTING, spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return spark.read.options(recursiveFileLookup=True).format("text").load(paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(str(paths)) from error
        raise
    finally:
        spark.conf.set(LISTING, usual)


def _header_names(line: str) -> Column:
    """Trimmed, lower-cased cells of a header line."""
    cells = F.split(F.regexp_replace(line, "^﻿", ""), COMMA)
    return F.transform(cells, lambda c: F.lower(F.trim(F.regexp_replace(F.trim(c), '^"|"$', ""))))


def file_headers(lines: DataFrame) -> DataFrame:
    """(file, names): trimmed, lower-cased header cells of every file; null for a file of blank lines.

    The first line that is not blank is the header. One pass over the files as lines, of which only
    one per file and task leaves the scan. Files of no bytes have no lines and are not listed.
    """
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        "value",
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    place = F.when((F.col("start") == 0) & (F.trim("value") != ""), F.col("at"))
    first = placed.groupBy("file").agg(F.min_by("value", place).alias("line"))
    return first.select("file", _header_names("line").alias("names"))


def _absent() -> Column:
    return F.array_except(F.array(*map(F.lit, REQUIRED_COLUMNS)), F.col("names"))


def _unreadable(headers: DataFrame) -> DataFrame:
    """Files no row of which can be read, with the reason."""
    reason = F.when(F.col("names").isNull(), NO_HEADER).when(
        F.size(_absent()) > 0, F.concat(F.lit(MISSING), F.array_join(_absent(), ", "))
    )
    found = headers.select("file", F.lit(None).cast("string").alias("line"), reason.alias("reason"))
    return found.filter(F.col("reason").isNotNull())


def _file_ticker() -> Column:
    """A ``ticker=...`` folder, else the file name."""
    path = F.url_decode("file")
    folder = F.nullif(F.regexp_extract(path, r"/ticker=([^/]+)/", 1), F.lit(""))
    name = F.regexp_extract(path, r"([^/]+?)(\.csv)?(\.gz)?$", 1)
    return F.coalesce(folder, name)


def _with_headers(rows: DataFrame, usable: DataFrame) -> DataFrame:
    """``rows`` with the names and the ticker of their file.

    Paths meet as hashes, so that all files fit a broadcast, unless two of them share one.
    """
    known = usable.withColumn("file_ticker", _file_ticker())
    if not is_small(usable, MAX_FILES):
        return rows.join(known, "file")
    hashed = materialize(known.select(F.xxhash64("file").alias("_file"), "names", "file_ticker"))
    if hashed.groupBy("_file").count().filter("count > 1").isEmpty():
        return rows.withColumn("_file", F.xxhash64("file")).join(F.broadcast(hashed), "_file").drop("_file")
    return rows.join(broadcast_if_small(known), "file")


def read_universe(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Bars of all CSV files below ``paths``, and what could not be read: (ticker, file, line, reason).

    Columns are matched by name file by file, in any order, case and number; of equal names the first
    counts. All files are listed once and are one scan of lines, joined with the header of their file, so neither the
    number of files nor of different headers adds jobs. Bars come typed as by ``read_bars``.

    A row with a date that is not ``yyyy-MM-dd``, a text that is neither a number nor a usual sign for a
    missing one, or more cells than the header is rejected with all its reasons; missing cells at the
    end are missing values. A file without a required column is rejected as a whole, as one row with no
    line, and so is a file of blank lines; a file of no bytes gives nothing. Header lines repeated inside a file are left out. Blank
    lines do not count. Paths that do not exist raise FileNotFoundError; each result is a scan of its own.
    """
    lines = _lines(spark, paths)
    headers = materialize(file_headers(lines))
    width = headers.agg(F.max(F.size("names"))).first()[0] or 0
    columns = [f"c{i}" for i in range(max(width, 0) + 1)]
    usable = headers.filter(F.col("names").isNotNull() & (F.size(_absent()) == 0))
    rows = _with_headers(_as_cells(lines, columns), usable)

    def cell(name: str) -> Column:
        return F.trim(F.get("cells", (F.array_position("names", name) - 1).cast("int")))

    numbers = {c: cell(c) for c in REQUIRED_COLUMNS if c != "date"}
    known = {c: F.when(~text.isin(MISSING_TEXTS), text) for c, text in numbers.items()}
    date = F.try_to_date(cell("date"), "yyyy-MM-dd")
    beyond = F.slice("cells", F.size("names") + 1, len(columns))
    faults = [
        (F.size(F.array_except(beyond, F.array(F.lit(None).cast("string")))) > 0, TOO_MANY),
        (date.isNull(), BAD_DATE),
        *[(v.isNotNull() & v.try_cast("double").isNull(), BAD_NUMBER + c) for c, v in known.items()],
    ]
    # Plain conditions tell the rows apart; reasons and lines are put together for rejected ones alone.
    faulty = reduce(Column.__or__, [wrong for wrong, _ in faults])
    reason = F.concat_ws("; ", *[F.when(wrong, text) for wrong, text in faults])
    same = F.transform(F.slice("cells", F.lit(1), F.size("names")), lambda c: F.lower(F.trim(F.coalesce(c, F.lit("")))))
    # What repeats the header holds its first name; only such lines are compared in full.
    header = F.lower("value").contains(F.col("names")[0]) & (
        same.eqNullSafe(F.col("names")) | _header_names("value").eqNullSafe(F.col("names"))
    )
    line = F.array_join(F.transform("cells", lambda c: F.coalesce(c, F.lit(""))), ",")
    data = rows.filter(~header)
    ticker = F.coalesce(cell("ticker"), "file_ticker").alias("ticker")
    bars = data.filter(~faulty).select(
        ticker,
        date.alias("date"),
        *[v.try_cast("double").alias(c.replace(" ", "_")) for c, v in known.items()],
    )
    bad_rows = data.filter(faulty).select(ticker, "file", F.regexp_replace(line, ",+$", "").alias("line"), reason.alias("reason"))
    bad_files = _unreadable(headers).select(
        _file_ticker().alias("ticker"), "file", "line", "reason"
    )
    return bars, bad_files.unionByName(bad_rows)


def _as_cells(lines: DataFrame, columns: list[str]) -> DataFrame:
    """(file, value, cells) of all lines that are not blank."""
    schema = ", ".join(f"{c} string" for c in columns)
    parts = lines.filter(F.col("value").rlike(r"[^\x00-\x20]")).select(
        F.col("_metadata.file_path").alias("file"), "value", F.from_csv("value", schema).alias("_cells")
    )
    return parts.select("file", "value", F.array(*[F.col(f"_cells.{c}") for c in columns]).alias("cells"))
