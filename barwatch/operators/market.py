"""Market-wide daily indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.config import STRESS_FLAG_RATE, Period
from barwatch.sources.tables import within


def universe_size(features: DataFrame) -> Column:
    """Number of distinct tickers, as a scalar subquery."""
    return features.agg(F.countDistinct("ticker")).scalar()


def breadth_of(ret: str = "ret") -> Column:
    """Share of rows with a positive return; a missing return is not positive."""
    return F.avg(F.when(F.col(ret) > 0, 1.0).otherwise(0.0))


def flag_rate(anomalies: DataFrame, features: DataFrame) -> DataFrame:
    """date, flag_rate: share of the universe that the given detector flagged that day."""
    flagged = anomalies.groupBy("date").agg(F.countDistinct("ticker").alias("flagged"))
    return flagged.select(
        "date", (F.col("flagged") / universe_size(features).cast("double")).alias("flag_rate")
    )


def market_day_table(
    features: DataFrame, anomalies: DataFrame, flag_thresh: float = STRESS_FLAG_RATE
) -> DataFrame:
    """One row per feature date: mean return, breadth, flag rate and the stress flag."""
    days = features.groupBy("date").agg(
        F.coalesce(F.avg("ret"), F.lit(0.0)).alias("market_ret"), breadth_of().alias("breadth")
    )
    # One row per calendar day at most: the date type bounds what is broadcast.
    rates = F.broadcast(flag_rate(anomalies, features))
    rate = F.coalesce("flag_rate", F.lit(0.0))
    return days.join(rates, "date", "left").select(
        "date",
        "market_ret",
        "breadth",
        rate.alias("flag_rate"),
        (rate > flag_thresh).cast("int").alias("market_anomaly_flag"),
    )


def anomaly_mean_return(anomalies: DataFrame, period: Period) -> DataFrame:
    """date, r_mkt: mean return over the flagged rows only."""
    return (
        within(anomalies, period.first, period.last)
        .groupBy("date")
        .agg(F.avg("ret").alias("r_mkt"))
    )


def period_breadth(features: DataFrame, period: Period) -> DataFrame:
    return (
        within(features, period.first, period.last)
        .groupBy("date")
        .agg(breadth_of().alias("breadth"))
    )


def consensus_market(
    features: DataFrame, rate_source: DataFrame, return_source: DataFrame, period: Period
) -> DataFrame:
    """Flag rate, mean return of flagged rows and breadth side by side; missing days stay null."""
    return (
        flag_rate(rate_source, features)
        .join(anomaly_mean_return(return_source, period), "date", "full")
        .join(period_breadth(features, period), "date", "full")
    )
