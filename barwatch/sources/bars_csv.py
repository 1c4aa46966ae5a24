"""Bars from CSV files, one file per ticker."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.config import REQUIRED_COLUMNS

# Texts that CSV readers commonly take as a missing number.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _number(name: str) -> Column:
    """The text as a double; missing texts become null, other non-numbers fail the query."""
    text = F.trim(F.col(f"`{name}`"))
    return F.when(~text.isin(MISSING_TEXTS), text).cast("double")


def require_columns(df: DataFrame, required: list[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def read_bars(
    spark: SparkSession, paths: str | list[str], ticker: str | None = None, check_dates: bool = True
) -> DataFrame:
    """Read one or many ``<TICKER>.csv`` files, or folders of them, as one distributed scan.

    Header names are lower-cased, the required columns kept and typed, and ``adj close`` renamed to
    ``adj_close``. The ticker is the one given, else a ``ticker`` column (as ``ticker=...`` folders
    give), else the file name. A header that differs between files fails instead of shifting
    columns: read such files apart and ``union_bars`` them.

    A date that is missing or not ``yyyy-MM-dd`` raises ValueError, for which one pass over the
    date column runs here; ``check_dates=False`` leaves such dates null.
    """
    try:
        raw = spark.read.csv(paths, header=True, enforceSchema=False)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(str(paths)) from error
        raise
    named = raw.toDF(*[c.strip().lower() for c in raw.columns])
    require_columns(named, REQUIRED_COLUMNS)

    originals = dict(zip(named.columns, raw.columns))
    if ticker is not None:
        name = F.lit(ticker)
    elif "ticker" in originals:
        name = F.col(f"`{originals['ticker']}`").cast("string")
    else:
        name = F.regexp_extract(F.col("_metadata.file_name"), r"([^/]+)\.csv", 1)
    parsed = raw.select(
        name.alias("ticker"),
        *[F.col(f"`{originals[c]}`").alias(c) for c in REQUIRED_COLUMNS],
    ).select(
        "ticker",
        F.try_to_date("date", "yyyy-MM-dd").alias("date"),
        *[_number(c).alias(c.replace(" ", "_")) for c in REQUIRED_COLUMNS[1:]],
    )
    if check_dates:
        unparsed = parsed.filter(F.col("date").isNull()).select("ticker").limit(5).collect()
        if unparsed:
            where = sorted({r["ticker"] for r in unparsed})
            raise ValueError(f"unparseable or missing dates, e.g. in {where}")
    return parsed


def union_bars(frames: list[DataFrame]) -> DataFrame:
    """Stack separately read frames by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
