"""Aggregates over event-time windows; the same functions work on tables and on streams.

On a stream, a window is given out once the watermark, the latest time seen less ``delay``, has passed its
end. Rows behind the watermark are left out, so state holds the open windows only. Rows without a time are
in no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _over(rows: DataFrame, time: str, delay: str, window: Column, keys: Sequence[str], values: Sequence[Column]) -> DataFrame:
    named = rows.withWatermark(time, delay).groupBy(window.alias("_window"), *keys).agg(*values)
    rest = [c for c in named.columns if c != "_window"]
    bounds = [F.unix_seconds(f"_window.{b}").alias(f"window_{b}") for b in ("start", "end")]
    return named.select(*bounds, *rest)


def tumbling(rows: DataFrame, time: str, width: str, keys: Sequence[str], values: Sequence[Column], delay: str = "0 seconds") -> DataFrame:
    """window_start, window_end (Unix seconds), keys, values: each row counts in one window."""
    return _over(rows, time, delay, F.window(time, width), keys, values)


def sliding(
    rows: DataFrame, time: str, width: str, step: str, keys: Sequence[str], values: Sequence[Column], delay: str = "0 seconds"
) -> DataFrame:
    """As `tumbling`, with a window of ``width`` starting every ``step``: each row counts in width / step of them."""
    return _over(rows, time, delay, F.window(time, width, step), keys, values)


def sessions(
    rows: DataFrame, time: str, gap: str, keys: Sequence[str], values: Sequence[Column], delay: str = "0 seconds"
) -> DataFrame:
    """As `tumbling`, per run of rows of one key less than ``gap`` apart; a session ends ``gap`` after its last row.

    Sessions are merged before the shuffle, so that a busy key reaches its task as few rows.
    """
    rows = rows.filter(F.col(time).isNotNull())
    conf = rows.sparkSession.conf
    setting = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    if rows.isStreaming and conf.get(setting, "false") != "true":
        conf.set(setting, "true")
    return _over(rows, time, delay, F.session_window(time, gap), keys, values)
