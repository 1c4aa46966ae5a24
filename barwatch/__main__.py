"""Commands on stored tables: ``spark-submit`` this package, or ``python -m barwatch``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from barwatch.plans.detect import run_detection
from barwatch.plans.serving import build_serving_tables, query_date, query_month
from barwatch.session import drop_intermediate
from barwatch.sources.bars_csv import read_bars


def _present(df: DataFrame, out: str | None, rows: int | None, empty: str) -> None:
    """Write the whole result to ``out``, or print it row by row (only the first ``rows``, if given)."""
    if out:
        df.write.mode("overwrite").csv(out, header=True)
    elif df.isEmpty():
        print(empty)
    else:
        print(*df.columns, sep="\t")
        for row in (df if rows is None else df.limit(rows)).toLocalIterator():
            print(*row, sep="\t")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="barwatch", description=__doc__)
    parser.add_argument("--tables", required=True, help="folder of the result tables")
    commands = parser.add_subparsers(dest="command", required=True)
    detect = commands.add_parser("detect", help="bars to features and anomaly tables")
    detect.add_argument("--bars", required=True, nargs="+", help="CSV files or folders")
    commands.add_parser("walkforward", help="build the daily card and the market table")
    query = commands.add_parser("query", help="market status and anomalous tickers of a date")
    query.add_argument("--date", required=True, type=dt.date.fromisoformat)
    monthly = commands.add_parser("monthly", help="anomalies of a month with the stress flag")
    monthly.add_argument("--month", required=True, help="YYYY-MM")
    for command in (query, monthly):
        command.add_argument("--rows", type=int, help="rows to show; all if not given")
        command.add_argument("--out", help="write all rows as CSV to this folder instead")
    chosen = parser.parse_args(arguments)

    spark = SparkSession.builder.appName(f"barwatch {chosen.command}").getOrCreate()
    if chosen.command == "detect":
        run_detection(read_bars(spark, chosen.bars), chosen.tables)
        drop_intermediate(spark)
    elif chosen.command == "walkforward":
        build_serving_tables(spark, chosen.tables)
    elif chosen.command == "query":
        market, flagged = query_date(spark, chosen.tables, chosen.date)
        _present(market, None, chosen.rows, f"No market data for {chosen.date}")
        _present(flagged, chosen.out, chosen.rows, f"No anomalies found for {chosen.date}")
    else:
        report = query_month(spark, chosen.tables, chosen.month)
        _present(report, chosen.out, chosen.rows, f"No anomalies found for month {chosen.month}")


if __name__ == "__main__":
    main()
