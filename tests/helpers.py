"""Small frames for the tests."""

import datetime as dt

import numpy as np
from pyspark.sql import DataFrame, SparkSession

BARS = (
    "ticker string, date date, open double, high double, low double, close double, "
    "adj_close double, volume double"
)
FEATURES = "date date, ticker string, ret double, ret_z double, vol_z double, range_pct double"
POINTS = "date date, ticker string, ret double, ret_z double, vol_z double, range_pct double"


def day(n: int, start: dt.date = dt.date(2020, 1, 1)) -> dt.date:
    return start + dt.timedelta(days=n)


def bar(ticker="A", date=dt.date(2020, 1, 1), open=10.0, high=11.0, low=9.0, close=10.0,
        adj_close=None, volume=100.0):
    return (ticker, date, open, high, low, close, close if adj_close is None else adj_close, volume)


def bars(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, BARS)


def feature_rows(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, FEATURES)


def point_frame(spark: SparkSession, xyz: np.ndarray) -> DataFrame:
    """Points with coordinates in the feature columns, keyed by row number in row order."""
    rows = [
        (day(i % 1000), f"T{i // 1000:04d}", 0.0, float(x), float(y), float(z))
        for i, (x, y, z) in enumerate(xyz)
    ]
    return spark.createDataFrame(rows, POINTS)


def row_number_of(row) -> int:
    return int(row["ticker"][1:]) * 1000 + (row["date"] - day(0)).days
