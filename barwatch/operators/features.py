"""Past-only features of daily bars, computed per ticker."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barwatch.config import FeatureParams
from barwatch.functions.history import PIECE, cut_history, own_rows
from barwatch.functions.trailing import (
    log_volume,
    relative_range,
    simple_return,
    trailing_share_at_most,
    trailing_zscore,
)
from barwatch.operators.long_rank import trailing_rank

LONG_WINDOW = 512
"""Rows from which a rank is counted in blocks instead of over a list per row."""


def number(name: str) -> Column:
    """The column as a double, with NaN read as missing."""
    value = F.col(name).cast("double")
    return F.when(~F.isnan(value), value)


def _by_ticker(
    rows: DataFrame, lookback: int, piece_rows: int | None, add: Callable[..., DataFrame]
) -> DataFrame:
    """Run ``add(rows, order)`` over whole histories, or over pieces of ``piece_rows`` rows."""
    if piece_rows is None:
        return add(rows, Window.partitionBy("ticker").orderBy("date"))
    pieces = cut_history(rows, "ticker", "date", lookback, piece_rows)
    return own_rows(add(pieces, Window.partitionBy("ticker", PIECE).orderBy("date")))


def compute_features(
    bars: DataFrame, params: FeatureParams = FeatureParams(), piece_rows: int | None = None
) -> DataFrame:
    """date, ticker, ret, ret_z, vol_z, range_pct.

    All features share one shuffle and one sort by (ticker, date). Bars are unique per ticker and
    date, so the calendar bounds a ticker's group; with ``piece_rows`` set, histories are cut into
    overlapping pieces of that many rows instead and the result is the same, for bars whose key is
    not unique. A range window of ``LONG_WINDOW`` rows or more is ranked in blocks (``trailing_rank``).
    """
    source = bars.select(
        "date",
        "ticker",
        number("adj_close").alias("adj_close"),
        log_volume(number("volume")).alias("log_volume"),
        relative_range(number("high"), number("low"), number("close")).alias("span"),
    )
    long = params.range_window >= LONG_WINDOW
    if long:
        source = trailing_rank(source, "ticker", "date", "span", params.range_window, "range_pct")

    def add(rows: DataFrame, order: WindowSpec) -> DataFrame:
        returns = rows.withColumn("ret", simple_return(F.col("adj_close"), order))
        return returns.withColumns(
            {
                "ret_z": trailing_zscore(F.col("ret"), params.ret_window, order),
                "vol_z": trailing_zscore(F.col("log_volume"), params.vol_window, order),
                "range_pct": F.col("range_pct")
                if long
                else trailing_share_at_most(F.col("span"), params.range_window, order),
            }
        )

    scored = _by_ticker(source, params.lookback, piece_rows, add)
    return scored.select("date", "ticker", "ret", "ret_z", "vol_z", "range_pct")


def eda_columns(bars: DataFrame, piece_rows: int | None = None) -> DataFrame:
    """Daily return and log volume beside the adjusted close, for exploration only."""
    source = bars.select(
        "date",
        "ticker",
        number("adj_close").alias("adj_close"),
        log_volume(number("volume")).alias("log_volume"),
    )

    def add(rows: DataFrame, order: WindowSpec) -> DataFrame:
        return rows.withColumn("daily_return", simple_return(F.col("adj_close"), order))

    added = _by_ticker(source, 1, piece_rows, add)
    return added.select("date", "ticker", "adj_close", "daily_return", "log_volume")
