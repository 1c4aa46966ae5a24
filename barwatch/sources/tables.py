"""Result tables on shared storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONTH = "month"


def month_of(date: str | Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def within(df: DataFrame, first: dt.date | Column, last: dt.date | Column) -> DataFrame:
    """Rows dated from ``first`` to ``last``, both included; dates or scalar columns.

    A table stored by month is also filtered by that column, so whole folders are skipped.
    """
    rows = df.filter((F.col("date") >= first) & (F.col("date") <= last))
    if MONTH in df.columns:
        low, high = month_of(F.lit(first)), month_of(F.lit(last))
        rows = rows.filter((F.col(MONTH) >= low) & (F.col(MONTH) <= high))
    return rows


def write_table(df: DataFrame, path: str, by_month: bool = True, fmt: str = "parquet") -> None:
    """Replace the table at ``path``; with ``by_month`` one folder per month of ``date``.

    Rows are rebalanced by month first, so a month becomes a few well-sized files instead of one
    per task, and a big month is split over several tasks. Inside a file rows are sorted by date, so
    that a query for one date skips the rest of the month by the file's statistics.
    """
    if by_month:
        df = df.withColumn(MONTH, month_of("date")).hint("rebalance", MONTH)
        df = df.sortWithinPartitions(MONTH, "date")
    writer = df.write.mode("overwrite").format(fmt)
    if by_month:
        writer = writer.partitionBy(MONTH)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Read a stored table. CSV needs its schema, Parquet brings it along."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("a CSV table needs an explicit schema")
        reader = reader.option("header", True).option("dateFormat", "yyyy-MM-dd")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
