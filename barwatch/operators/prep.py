"""From features to the scaled points the learned detectors work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.config import FEATURES, KEY, Splits
from barwatch.sources.tables import within


def feature_points(features: DataFrame) -> DataFrame:
    """Rows with all three features present: date, ticker, ret and the features."""
    return features.dropna(subset=FEATURES).select(*KEY, "ret", *FEATURES)


def split_by_date(points: DataFrame, splits: Splits = Splits()) -> DataFrame:
    """Add ``split`` (train, val, test) and drop rows outside all periods.

    Dates may be strings. The test is a plain date range, so it reaches a Parquet scan.
    """
    date = F.col("date").cast("date")
    periods = splits.items()
    label = F.lit(None).cast("string")
    inside = F.lit(False)
    for name, period in reversed(periods):
        here = date.between(period.first, period.last)
        label = F.when(here, name).otherwise(label)
        inside = inside | here
    return points.withColumn("date", date).filter(inside).withColumn("split", label)


def scaler(points: DataFrame, columns: list[str] = FEATURES) -> Column:
    """Mean and population deviation of the training rows, as a scalar subquery.

    A constant column is divided by 1.
    """

    def spread(c: str) -> Column:
        deviation = F.stddev_pop(c)
        return F.when(deviation == 0, 1.0).otherwise(deviation)

    stats = [F.struct(F.avg(c).alias("mean"), spread(c).alias("scale")).alias(c) for c in columns]
    return points.filter(F.col("split") == "train").agg(F.struct(*stats)).scalar()


def scale_features(points: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Replace the features by their z-scores against the training split."""
    fitted = scaler(points, columns)
    return (
        points.withColumn("_fit", fitted)
        .withColumns(
            {
                c: (F.col(c) - F.col(f"_fit.{c}.mean")) / F.col(f"_fit.{c}.scale")
                for c in columns
            }
        )
        .drop("_fit")
    )


def scaled_points(features: DataFrame, splits: Splits = Splits()) -> DataFrame:
    """date, ticker, ret, scaled features and split, from the dates the splits cover."""
    periods = [period for _, period in splits.items()]
    features = within(
        features, min(p.first for p in periods), max(p.last for p in periods)
    )
    return scale_features(split_by_date(feature_points(features), splits))
