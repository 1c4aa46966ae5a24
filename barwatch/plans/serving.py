"""Serving tables and the queries on them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from barwatch.config import STRESS_FLAG_RATE
from barwatch.operators.market import market_day_table
from barwatch.operators.reporting import (
    anomalies_on_date,
    daily_card,
    market_on_date,
    monthly_report,
)
from barwatch.plans.detect import DBSCAN_TABLE, FEATURES_TABLE, KMEANS_TABLE, RULE_TABLE
from barwatch.sources.tables import read_table, write_table

# Names of the stored tables.
CARD_TABLE = "daily_anomaly_card"
MARKET_TABLE = "market_day_table"


def build_serving_tables(
    spark: SparkSession, tables_dir: str, flag_thresh: float = STRESS_FLAG_RATE
) -> dict[str, str]:
    """Daily card and market table from the stored detection results; returns their paths.

    The card is written first and read back, since it is the anomaly source of the market table,
    which has one row per day and is therefore not split by month.
    """

    def stored(name: str) -> DataFrame:
        return read_table(spark, f"{tables_dir}/{name}")

    features = stored(FEATURES_TABLE)
    card = daily_card(features, stored(RULE_TABLE), stored(KMEANS_TABLE), stored(DBSCAN_TABLE))
    write_table(card, f"{tables_dir}/{CARD_TABLE}")
    market = market_day_table(features, stored(CARD_TABLE), flag_thresh)
    write_table(market, f"{tables_dir}/{MARKET_TABLE}", by_month=False)
    return {name: f"{tables_dir}/{name}" for name in (CARD_TABLE, MARKET_TABLE)}


def query_date(spark: SparkSession, tables_dir: str, date: dt.date) -> tuple[DataFrame, DataFrame]:
    """Market row and anomalous tickers of a date; of the card only that month's files are read."""
    market = read_table(spark, f"{tables_dir}/{MARKET_TABLE}")
    card = read_table(spark, f"{tables_dir}/{CARD_TABLE}")
    return market_on_date(market, date), anomalies_on_date(card, date)


def query_month(spark: SparkSession, tables_dir: str, month: str) -> DataFrame:
    """Report of a month (``YYYY-MM``); of the card only that month's files are read."""
    card = read_table(spark, f"{tables_dir}/{CARD_TABLE}")
    market = read_table(spark, f"{tables_dir}/{MARKET_TABLE}")
    return monthly_report(card, market, month)
