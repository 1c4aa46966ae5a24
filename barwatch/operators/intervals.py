"""Spans of time: runs of dated rows, and pairs of spans that overlap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROWTH = 8
"""Bins of a level are so many times as wide as those of the level below."""


def spells(rows: DataFrame, by: Sequence[str], date: str, gap_days: int) -> DataFrame:
    """by, first_date, last_date, rows: runs of dates of one key that are at most ``gap_days`` apart.

    Dates that repeat count as often as they are there; null dates are in no run.
    """
    order = Window.partitionBy(*by).orderBy(date)
    apart = F.coalesce(F.datediff(date, F.lag(date).over(order)) > gap_days, F.lit(True))
    run = F.sum(apart.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    runs = rows.filter(F.col(date).isNotNull()).withColumn("_run", run).groupBy(*by, "_run")
    return runs.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count("*").alias("rows")).drop("_run")


def _spans(side: DataFrame, by: Sequence[str], bounds: tuple[str, str], tag: str) -> DataFrame:
    """Keys, bounds in microseconds and the span's level: the lowest whose bins are as wide as it is long."""
    begin, end = (F.unix_micros(F.col(b).cast("timestamp")) for b in bounds)
    row = F.struct(*[F.col(f"`{c}`") for c in side.columns]).alias(f"_{tag}")
    keys = [F.col(b).alias(f"_key{i}") for i, b in enumerate(by)]
    spans = side.select(*keys, begin.alias(f"_{tag}_from"), end.alias(f"_{tag}_to"), row)
    spans = spans.filter(F.col(f"_{tag}_from") <= F.col(f"_{tag}_to"))
    length = F.greatest(F.col(f"_{tag}_to") - F.col(f"_{tag}_from"), F.lit(1))
    level = F.lit(0)
    for k in range(1, 22):  # 8 ** 21 microseconds are 292,000 years, the greatest difference of two times
        level = F.when(length > F.lit(GROWTH ** (k - 1)), k).otherwise(level)
    return spans.withColumn(f"_{tag}_level", level)


def _levels(spans: DataFrame, tag: str) -> list[int]:
    """The levels that occur, at most 22."""
    return sorted(r[0] for r in spans.select(f"_{tag}_level").distinct().collect())


def _binned(spans: DataFrame, tag: str, own: list[int], other: list[int]) -> DataFrame:
    """Each span in the one or two bins it touches, at its own level and at every higher level of the other side."""
    mine = F.col(f"_{tag}_level")
    wanted = sorted({*own, *other})
    level = F.explode(F.filter(F.array(*[F.lit(k) for k in wanted]), lambda k: (k == mine) | ((k > mine) & k.isin(other or [-1]))))
    at = spans.withColumn("_level", level)
    width = F.element_at(F.create_map(*[F.lit(x) for k in wanted for x in (k, GROWTH**k)]), F.col("_level"))

    def bin_of(bound: str) -> Column:
        value = F.col(f"_{tag}_{bound}")
        return F.expr(f"_{tag}_{bound} div _width") - ((value < 0) & (value % F.col("_width") != 0)).cast("long")

    at = at.withColumn("_width", width.cast("long"))
    at = at.withColumn(f"_{tag}_first", bin_of("from")).withColumn("_bin", F.explode(F.sequence(F.col(f"_{tag}_first"), bin_of("to"))))
    return at.drop("_width")


def interval_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str]
) -> DataFrame:
    """All pairs of rows with equal ``by`` columns whose closed spans overlap: the columns of both sides.

    Bounds are dates or timestamps. Spans with a missing bound, with a missing key, or that end before they begin overlap
    nothing. Only the ``by`` columns may be named alike; they come once.

    A span is put into bins at least as wide as it is long, of which it touches two at most; bins of higher levels are
    eight times as wide. Two spans meet at the higher of their levels, so a long span is in two wide bins instead of in many narrow ones, and
    short spans are compared with it only there. It is an equi-join on (keys, level, bin), and a pair comes out
    of its first common bin.
    """
    clash = (set(left.columns) & set(right.columns)) - set(by)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    a, b = _spans(left, by, left_bounds, "l"), _spans(right, by, right_bounds, "r")
    in_a, in_b = _levels(a, "l"), _levels(b, "r")
    keys = [f"_key{i}" for i in range(len(by))]
    pairs = _binned(a, "l", in_a, in_b).join(_binned(b, "r", in_b, in_a), [*keys, "_level", "_bin"])
    met = (
        (F.col("_level") == F.greatest("_l_level", "_r_level"))
        & (F.col("_bin") == F.greatest("_l_first", "_r_first"))
        & (F.col("_l_from") <= F.col("_r_to"))
        & (F.col("_r_from") <= F.col("_l_to"))
    )
    rest = [F.col(f"_r.`{c}`") for c in right.columns if c not in by]
    return pairs.filter(met).select("_l.*", *rest)
