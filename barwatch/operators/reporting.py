"""Daily anomaly card and the queries served from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.config import FEATURES, KEY
from barwatch.sources.tables import within


def _text_ticker(df: DataFrame) -> DataFrame:
    return df.withColumn("ticker", F.col("ticker").cast("string"))


def daily_card(
    features: DataFrame, rule: DataFrame, kmeans: DataFrame, dbscan: DataFrame
) -> DataFrame:
    """Rule anomalies with feature values from the features table, distance and density flag.

    Starts from the rules: what only K-Means or DBSCAN found is not on the card. ``distance`` is
    left out if the K-Means table has none. Of the features only the dates between the first and
    the last rule anomaly are read (the limits are scalar subqueries, which reach the scan), and of
    those only the keys of rule anomalies go on.
    """
    features, rule, kmeans, dbscan = map(_text_ticker, (features, rule, kmeans, dbscan))
    base = rule.select(*KEY, "anomaly_flag", "type", "why")
    first, last = rule.agg(F.min("date")).scalar(), rule.agg(F.max("date")).scalar()
    flagged = within(features, first, last).join(base.select(*KEY), KEY, "left_semi")
    card = base.join(flagged.select(*KEY, "ret", *FEATURES), KEY, "left")
    if "distance" in kmeans.columns:
        card = card.join(kmeans.select(*KEY, "distance"), KEY, "left")
    noise = dbscan.select(*KEY, F.lit(1).alias("dbscan_flag"))
    return card.join(noise, KEY, "left").withColumn(
        "dbscan_flag", F.coalesce("dbscan_flag", F.lit(0)).cast("int")
    )


def _in_month(df: DataFrame, first: dt.date) -> DataFrame:
    last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    return within(df, first, last)


def market_on_date(market: DataFrame, date: dt.date) -> DataFrame:
    return within(market, date, date).select(
        "date", "market_ret", "breadth", "flag_rate", "market_anomaly_flag"
    )


def anomalies_on_date(card: DataFrame, date: dt.date) -> DataFrame:
    return within(card, date, date).select("ticker", "type", "ret_z", "vol_z", "why")


def monthly_report(card: DataFrame, market: DataFrame, month: str) -> DataFrame:
    """Card rows of a month (``YYYY-MM``) with that day's stress flag, by date and ticker.

    A month without anomalies gives an empty table with the same columns.
    """
    first = dt.datetime.strptime(month, "%Y-%m").date()
    # At most 31 rows of one month, one per day.
    stress = F.broadcast(_in_month(market, first).select("date", "market_anomaly_flag"))
    return (
        _in_month(card, first)
        .join(stress, "date", "left")
        .select("date", "ticker", "type", "ret_z", "vol_z", "market_anomaly_flag", "why")
        .orderBy("date", "ticker")
    )
