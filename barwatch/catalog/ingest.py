"""Queries on files with differing headers, corrections by month, long ranks and findings as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.catalog.queries import _dirty, query
from barwatch.operators import quality
from barwatch.operators.features import compute_features
from barwatch.operators.long_rank import trailing_rank
from barwatch.plans.upserts import upsert_bars
from barwatch.session import materialize, new_folder
from barwatch.sources.panel import NARROW, read_panel
from barwatch.sources.tables import read_table, write_table
from barwatch.sources.universe_csv import read_universe

# Parameters shared with the SQL of the oracle.
LONG_ROWS = 300
FIRST_CORRECTED, LAST_CORRECTED = "1997-03-10", "1997-03-20"
FIRST_LATE, LAST_LATE = "1998-01-28", "1998-02-03"
# End of fixed values.


def _universe(spark: SparkSession, sf_dir: str) -> str:
    """All bars as CSV with three kinds of headers, one without ``Low``, and with faults by day of the month.

    On the 13th dates have slashes, on the 17th the open is no number, on the 19th the low is not given.
    """
    path, day = new_folder(spark), F.dayofmonth("date")
    wrong = F.when(day == 13, F.date_format("date", "yyyy/MM/dd")).otherwise(F.date_format("date", "yyyy-MM-dd"))
    rows = materialize(read_panel(spark, sf_dir)).select(
        "ticker",
        (F.substring("ticker", 2, 9).cast("int") % 5).alias("form"),
        wrong.alias("date"),
        F.when(day == 17, "n.q.").otherwise(F.col("open").cast("string")).alias("open"),
        "high",
        F.when(day == 19, "n/a").otherwise(F.col("low").cast("string")).alias("low"),
        "close",
        F.col("adj_close").alias("Adj Close"),
        "volume",
    )
    usual = ["date", "open", "high", "low", "close", "Adj Close", "volume"]

    def deliver(some: Column, columns: list, name: str) -> None:
        part = rows.filter(some).select("ticker", *columns).hint("rebalance", "ticker")
        part.write.partitionBy("ticker").csv(f"{path}/{name}", header=True)

    deliver(F.col("form") == 0, [c for c in usual if c != "low"], "no_low")
    turned = [F.lit("x").alias("Note"), *[F.col(c).alias(c.upper()) for c in reversed(usual)]]
    deliver(F.col("form").isin(1, 2), turned, "turned")
    deliver(F.col("form") > 2, usual, "usual")
    return path


@query
def csv_universe_bars(spark, sf_dir):
    return read_universe(spark, _universe(spark, sf_dir))[0]


@query
def csv_universe_rejected(spark, sf_dir):
    """Rejected lines per ticker and reason; a file without a required column counts no lines."""
    rejected = read_universe(spark, _universe(spark, sf_dir))[1]
    return rejected.groupBy("ticker", "reason").agg(F.count("line").alias("lines"))


@query
def column_findings(spark, sf_dir):
    """Bars that came without an adjusted close: which columns are there, and how often they are empty."""
    some = _dirty(spark, sf_dir).drop("adj_close")
    holes = F.when(F.dayofmonth("date") != 9, F.col("open"))
    return quality.column_findings(some.withColumn("open", holes))


@query
def strict_findings(spark, sf_dir):
    return quality.strict_findings(_dirty(spark, sf_dir))


@query
def long_range_rank(spark, sf_dir):
    """Share of the 300 bars before each bar with a range at most its own, counted in blocks."""
    bars = read_panel(spark, sf_dir, NARROW)
    spans = bars.select("ticker", "date", F.try_divide(F.col("high") - F.col("low"), "close").alias("span"))
    return trailing_rank(spans, "ticker", "date", "span", LONG_ROWS, "span_rank")


def _corrected(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Stored bars and features, after late and corrected bars were put in."""
    bars = read_panel(spark, sf_dir)
    late = F.col("date").between(FIRST_LATE, LAST_LATE)
    wrong = F.col("date").between(FIRST_CORRECTED, LAST_CORRECTED) & F.col("ticker").endswith("3")
    bars_path, features_path = new_folder(spark), new_folder(spark)
    raised = {c: F.when(wrong, F.col(c) * 1.25).otherwise(F.col(c)) for c in ("high", "adj_close")}
    write_table(bars.withColumns(raised).filter(~late), bars_path)
    write_table(compute_features(read_table(spark, bars_path).drop("month")), features_path)
    upsert_bars(spark, bars_path, features_path, bars.filter(late | wrong))
    return bars_path, features_path


@query
def corrected_bars(spark, sf_dir):
    return read_table(spark, _corrected(spark, sf_dir)[0]).drop("month")


@query
def corrected_features(spark, sf_dir):
    return read_table(spark, _corrected(spark, sf_dir)[1]).drop("month")
