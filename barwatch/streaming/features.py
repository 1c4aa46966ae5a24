"""Trailing features of bars that arrive as a stream, out of order, from state per ticker."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barwatch.config import FeatureParams
from barwatch.functions.trailing import log_volume, relative_range
from barwatch.operators.features import number
from barwatch.session import ship_package

VALUES = ["price", "log_volume", "span"]
OUT = "date date, ticker string, ret double, ret_z double, vol_z double, range_pct double"
STATE = ", ".join(f"{part}_{c} array<{t}>" for part in ("past", "open") for c, t in (("day", "int"), *((v, "double") for v in VALUES)))
DAY_MS = 86_400_000


def trailing_zscores(values: np.ndarray, rows: int) -> np.ndarray:
    """Distance of each value from the mean of the ``rows`` before it in sample deviations.

    NaN unless all of these are known and they vary.
    """
    padded = np.concatenate([np.full(rows, np.nan), values])
    past = sliding_window_view(padded, rows)[:-1]
    with np.errstate(invalid="ignore", divide="ignore"):
        deviation = np.where(past.max(axis=1) > past.min(axis=1), past.std(axis=1, ddof=1), np.nan)
        return (values - past.mean(axis=1)) / deviation


def trailing_shares(values: np.ndarray, rows: int) -> np.ndarray:
    """Share of the ``rows`` values before each that are at most it; NaN until there are so many."""
    out = np.full(len(values), np.nan)
    if len(values) > rows:
        past = sliding_window_view(values, rows)[:-1]
        out[rows:] = (past <= values[rows:, None]).sum(axis=1) / rows
    return out


def feature_table(table: np.ndarray, params: FeatureParams) -> np.ndarray:
    """ret, ret_z, vol_z, range_pct of rows (price, log_volume, span) in order of dates."""
    price, volume, span = table
    ret = np.full(len(price), np.nan)
    with np.errstate(invalid="ignore", divide="ignore"):
        ret[1:] = np.where(price[:-1] == 0, np.nan, price[1:] / price[:-1] - 1)
    return np.stack(
        [
            ret,
            trailing_zscores(ret, params.ret_window),
            trailing_zscores(volume, params.vol_window),
            trailing_shares(span, params.range_window),
        ]
    )


def stream_features(bars: DataFrame, delay: str, params: FeatureParams = FeatureParams()) -> DataFrame:
    """date, ticker, ret, ret_z, vol_z, range_pct of streamed ``bars``, equal to `compute_features` of the table.

    A bar waits in its ticker's state until the watermark, the latest date seen less ``delay``, reaches its date; then
    it is judged against the rows before it, of which the state keeps as many as the windows need. So bars may
    arrive in any order within the delay. One that comes behind the watermark is left out; of bars with one
    ticker and date the one that arrives last before that counts. State per ticker is the lookback and the open bars.
    """
    source = bars.select(
        F.col("date").cast("timestamp").alias("at"),
        "ticker",
        number("adj_close").alias("price"),
        log_volume(number("volume")).alias("log_volume"),
        relative_range(number("high"), number("low"), number("close")).alias("span"),
    ).filter(F.col("at").isNotNull())

    def judge(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kept = state.get if state.exists else ([],) * 8
        past = np.array(kept[1:4], float).reshape(3, -1)
        waiting = {int(d): v for d, *v in zip(*kept[4:8])}
        last_day = int(kept[0][-1]) if len(kept[0]) else -(10**9)
        for batch in batches:
            days = (batch["at"].astype("datetime64[ms]").astype("int64") // DAY_MS).to_numpy()
            for day, *values in zip(days.tolist(), *(batch[v].to_numpy(float) for v in VALUES)):
                if day > last_day:
                    waiting[day] = values
        reached = state.getCurrentWatermarkMs() // DAY_MS
        ready = sorted(d for d in waiting if d <= reached)
        days = [int(d) for d in kept[0]]
        if ready:
            table = np.concatenate([past, np.array([waiting.pop(d) for d in ready], float).T], axis=1)
            found = feature_table(table, params)[:, past.shape[1] :]
            days = [*days, *ready][-params.lookback :]
            past = table[:, -params.lookback :]
            out = pd.DataFrame({"date": np.array(ready, "datetime64[D]").astype(object), "ticker": key[0]})
            for name, values in zip(("ret", "ret_z", "vol_z", "range_pct"), found):
                out[name] = pd.Series(values).astype(object).where(~np.isnan(values), None)
            yield out
        rest = sorted(waiting)
        columns = np.array([waiting[d] for d in rest], float).reshape(-1, 3).T
        state.update((days, *past.tolist(), rest, *columns.tolist()))
        if rest:
            state.setTimeoutTimestamp(rest[0] * DAY_MS)

    ship_package(bars.sparkSession)
    watched = source.withWatermark("at", delay).groupBy("ticker")
    return watched.applyInPandasWithState(judge, OUT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
