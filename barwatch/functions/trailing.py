"""Past-only window functions: the frame is the W rows before the current one, never the row itself."""

from __future__ import annotations

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F


def _past(order: WindowSpec, rows: int) -> WindowSpec:
    return order.rowsBetween(-rows, -1)


def simple_return(price: Column, order: WindowSpec) -> Column:
    """Relative change against the previous row; null on the first row and after a zero price."""
    return F.try_divide(price, F.lag(price).over(order)) - F.lit(1.0)


def log_volume(volume: Column) -> Column:
    """Natural log; zero and negative volumes count as missing."""
    return F.when(volume > 0, F.ln(volume.cast("double")))


def relative_range(high: Column, low: Column, close: Column) -> Column:
    return F.try_divide(high - low, close)


def trailing_zscore(value: Column, rows: int, order: WindowSpec) -> Column:
    """Distance from the mean of the past ``rows`` values in sample deviations.

    Null unless all ``rows`` past values are present and they vary.
    """
    past = _past(order, rows)
    score = F.try_divide(value - F.avg(value).over(past), F.stddev_samp(value).over(past))
    return F.when(F.count(value).over(past) == rows, score)


def trailing_share_at_most(value: Column, rows: int, order: WindowSpec) -> Column:
    """Share of the past ``rows`` rows whose value is at most the current one.

    Null until ``rows`` rows have passed. Missing past values count as above, and a missing
    current value therefore scores 0.
    """
    earlier = F.collect_list(value).over(_past(order, rows))
    at_most = F.size(F.filter(earlier, lambda v: v <= value))
    return F.when(F.row_number().over(order) > rows, at_most / F.lit(float(rows)))
