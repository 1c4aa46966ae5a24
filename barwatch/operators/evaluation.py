"""Counts, rates, overlaps and distributions over features and anomalies."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.config import HISTOGRAM_BINS, KEY, Period
from barwatch.sources.bars_csv import require_columns
from barwatch.sources.tables import within

ANOMALY_COLUMNS = [*KEY, "anomaly_flag"]


def in_period(df: DataFrame, period: Period) -> DataFrame:
    return within(df, period.first, period.last)


def of_ticker(df: DataFrame, ticker: str) -> DataFrame:
    return df.filter(F.col("ticker") == ticker)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    return df.orderBy(*KEY).limit(rows)


def unique_dates(anomalies: DataFrame) -> DataFrame:
    require_columns(anomalies, ANOMALY_COLUMNS)
    return anomalies.agg(F.countDistinct("date").alias("unique_dates"))


def anomaly_rate(anomalies: DataFrame, reference: DataFrame) -> DataFrame:
    """Distinct anomaly dates over distinct reference dates; null without reference dates."""
    flagged = anomalies.agg(F.countDistinct("date")).scalar()
    days = reference.agg(F.countDistinct("date").alias("reference_dates"))
    return days.select(
        flagged.alias("anomaly_dates"),
        "reference_dates",
        F.try_divide(
            flagged.cast("double"), F.col("reference_dates").cast("double")
        ).alias("anomaly_rate"),
    )


def tagged(detectors: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    """All detectors' rows in one frame, told apart by ``detector``."""
    parts = [
        df.select(F.lit(name).alias("detector"), *columns) for name, df in detectors.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _flags_by(keys: list[str], detectors: dict[str, DataFrame]) -> DataFrame:
    """One row per key with a 0/1 column per detector."""
    return (
        tagged(detectors, keys)
        .groupBy(*keys)
        .agg(
            *[
                F.max(F.when(F.col("detector") == name, 1).otherwise(0)).alias(name)
                for name in detectors
            ]
        )
    )


def overlap_dates(rule: DataFrame, kmeans: DataFrame) -> DataFrame:
    """Dates flagged by only one of the detectors and by both, in one pass."""
    days = _flags_by(["date"], {"rule": rule, "kmeans": kmeans})
    r, k = F.col("rule") == 1, F.col("kmeans") == 1
    return days.agg(
        F.count_if(r & ~k).alias("rule_only"),
        F.count_if(k & ~r).alias("kmeans_only"),
        F.count_if(r & k).alias("both"),
    )


def detector_dates(detectors: dict[str, DataFrame], by: list[str] | None = None) -> DataFrame:
    """Dates per detector and dates flagged by all of them, per group of ``by``."""
    group = by or []
    days = _flags_by([*group, "date"], detectors)
    everyone = reduce(Column.__and__, [F.col(name) == 1 for name in detectors])
    return days.groupBy(*group).agg(
        *[F.sum(name).alias(f"{name}_dates") for name in detectors],
        F.count_if(everyone).alias("all_dates"),
    )


def daily_counts(anomalies: DataFrame) -> DataFrame:
    require_columns(anomalies, ANOMALY_COLUMNS)
    return anomalies.groupBy("date").agg(F.count(F.lit(1)).alias("anomalies")).orderBy("date")


def ticker_counts(anomalies: DataFrame) -> DataFrame:
    require_columns(anomalies, ANOMALY_COLUMNS)
    counts = anomalies.groupBy("ticker").agg(F.count(F.lit(1)).alias("anomalies"))
    return counts.orderBy(F.desc("anomalies"), "ticker")


def type_counts(rule: DataFrame) -> DataFrame:
    counts = rule.groupBy("type").agg(F.count(F.lit(1)).alias("anomalies"))
    return counts.orderBy(F.desc("anomalies"), "type")


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    require_columns(anomalies, ANOMALY_COLUMNS)
    return anomalies.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("date").alias("unique_dates"),
        F.countDistinct("ticker").alias("unique_tickers"),
    ).withColumn(
        "avg_anomalies_per_day",
        F.try_divide(F.col("rows").cast("double"), F.col("unique_dates").cast("double")),
    )


def detector_daily_counts(detectors: dict[str, DataFrame]) -> DataFrame:
    """Flagged rows per date, one count column per detector."""
    return (
        tagged(detectors, ["date"])
        .groupBy("date")
        .agg(*[F.count_if(F.col("detector") == name).alias(name) for name in detectors])
    )


def point_flag_rates(detectors: dict[str, DataFrame], points: DataFrame) -> DataFrame:
    """Per detector: flagged points, points scored and the rate in percent."""
    total = points.agg(F.count(F.lit(1))).scalar()
    # Grouping an empty detector away would lose its row, so the sums go over fixed columns.
    flagged = tagged(detectors, []).agg(
        *[F.count_if(F.col("detector") == name).alias(name) for name in detectors]
    )
    long = flagged.unpivot([], list(detectors), "detector", "flagged")
    rate = F.try_divide(F.col("flagged") * 100.0, F.col("points").cast("double"))
    return long.withColumn("points", total).withColumn("flag_rate_pct", rate)


def null_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of missing values per column, one row per column."""
    wide = df.agg(*[F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "null_share")


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson matrix in long form over pairwise complete rows, all pairs in one aggregate."""
    pairs = list(combinations_with_replacement(columns, 2))

    def corr(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        return F.corr(F.when(both, F.col(a)), F.when(both, F.col(b)))

    row = df.agg(*[corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = F.array(
        *[
            F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"`{a}|{b}`").alias("corr"))
            for a, b in pairs
            for x, y in ({(a, b), (b, a)})
        ]
    )
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def histogram(
    df: DataFrame,
    columns: list[str],
    bins: int = HISTOGRAM_BINS,
    by: str | None = None,
    groups: list[str] | None = None,
    density: bool = False,
) -> DataFrame:
    """Equal-width bins between each column's smallest and largest value.

    With ``by`` one histogram per value listed in ``groups`` (for instance the splits); listing
    them bounds the broadcast table of limits to one row per column and group. Empty bins have no
    points. With ``density`` the bars of a histogram have total area 1. A column whose values are all
    equal gets a range of width 1 around the value.
    """
    names = [by] if by else []
    keys = [*names, "feature"]
    if by:
        df = df.filter(F.col(by).isin(groups))
    long = df.unpivot(names, columns, "feature", "value").filter(F.col("value").isNotNull())
    limits = long.groupBy(*keys).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("total")
    )
    flat = F.col("low") == F.col("high")
    limits = limits.select(
        *keys,
        "total",
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.lit(1.0)).otherwise(F.col("high") - F.col("low")).alias("span"),
    )
    position = F.floor((F.col("value") - F.col("low")) / F.col("span") * bins)
    binned = (
        long.join(F.broadcast(limits), keys)
        .withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.count("*").alias("found"))
    )
    every = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    binned = every.join(binned, [*keys, "bin"], "left").withColumn("points", F.coalesce("found", F.lit(0)))
    left = F.col("low") + F.col("bin") * F.col("span") / bins
    out = [*keys, "bin", left.alias("bin_start"), "points"]
    if density:
        out.append((F.col("points") * bins / (F.col("total") * F.col("span"))).alias("density"))
    return binned.select(*out)
