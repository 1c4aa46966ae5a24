"""Exact percentiles per group without holding a group in one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwatch.session import is_small, materialize

SKETCH = 4096
"""Size of the KLL sketches: about 100 kB each, whatever the rows."""

SETTLE_ROWS = 200_000
"""Different values in the brackets of all groups up to which they are ranked at once."""

Bracket = tuple[float, float]


def margin(sketch: int) -> float:
    """Share of the rows by which a sketch of this size misses a rank, four times over."""
    return 4 * 2.3 / sketch**0.9


def percentile_by_group(
    df: DataFrame, group: str, value: str, percent: float, sketch: int = SKETCH, settle_rows: int = SETTLE_ROWS
) -> DataFrame:
    """(group, threshold): linearly interpolated percentile of ``value`` in each integer group. Exact.

    The built-in exact aggregate keeps every distinct value of a group in one task. Here a first pass counts each
    group and makes a mergeable KLL sketch of it, whose quantiles on both sides of the percentile are a bracket;
    a second pass counts what lies below the bracket and each value within it, which settles the rank.
    If so many values lie within that ranking them is no small matter, the bracket's rows, less than a
    hundredth of all, are stored and treated in the same way; if a sketch should miss, its group is treated
    without a bracket. Groups are model clusters, of which there are few.
    """
    q = percent / 100.0
    number = F.col(value).cast("double")
    known = materialize(df.filter(F.col(value).isNotNull()).select(group, number.alias("value")))
    off = margin(sketch)
    around = _sketched(known, group, [max(0.0, q - off), min(1.0, q + off)], sketch)
    at = {g: (n - 1) * q for g, (n, _) in around.items()}
    wanted = {g: (math.floor(a), math.ceil(a)) for g, a in at.items()}
    found = _ranked(known, group, wanted, {g: (v[0], v[1]) for g, (_, v) in around.items()}, sketch, settle_rows)
    rows = [(g, a + (b - a) * (at[g] - math.floor(at[g]))) for g, (a, b) in found.items()]
    kind = df.schema[group].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"{group} {kind}, threshold double")


def _sketched(rows: DataFrame, group: str, ranks: list[float], sketch: int) -> dict[int, tuple[int, list[float]]]:
    """Per group its size and the sketch's values at ``ranks``."""
    made = rows.groupBy(group).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("value", F.lit(sketch)).alias("sketch"))
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(r) for r in ranks]))
    return {r[0]: (r[1], list(r[2])) for r in made.select(group, "n", at).collect()}


def _ranked(
    rows: DataFrame, group: str, wanted: dict[int, tuple[int, int]], brackets: dict[int, Bracket], sketch: int, settle_rows: int
) -> dict[int, tuple[float, float]]:
    """The values at two ranks (from 0) of each group, which are expected within the brackets."""
    if not brackets:
        return {}
    spark = rows.sparkSession
    kind = rows.schema[group].dataType.simpleString()
    shape = f"{group} {kind}, low double, high double, first long, second long"
    few = F.broadcast(spark.createDataFrame([(g, *brackets[g], *wanted[g]) for g in brackets], shape))
    here = rows.join(few, group).filter(F.col("value") <= F.col("high"))
    # A null value stands for all that lies below the bracket.
    value = F.when(F.col("value") >= F.col("low"), F.col("value")).alias("value")
    counted = materialize(here.groupBy(group, value).agg(F.count("*").alias("n")))
    if not is_small(counted, settle_rows):
        return _closer(rows, group, wanted, brackets, counted, few, sketch, settle_rows)
    order = Window.partitionBy(group).orderBy(F.col("value").asc_nulls_first())
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))
    at = [F.min(F.when(F.col("upto") > F.col(rank), F.col("value"))) for rank in ("first", "second")]
    below = F.coalesce(F.max(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    placed = counted.withColumn("upto", upto).join(few, group)
    ends = placed.groupBy(group).agg(*at, below, F.max("upto")).collect()
    good = {g: (a, b) for g, a, b, under, whole in ends if under <= wanted[g][0] and wanted[g][1] < whole}
    missed = {g: (-math.inf, math.inf) for g in brackets if g not in good}
    return good | _ranked(rows, group, wanted, missed, sketch, settle_rows)


def _closer(rows, group, wanted, brackets, counted, few, sketch, settle_rows) -> dict[int, tuple[float, float]]:
    """As `_ranked`, from new sketches of the rows within the brackets."""
    below = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
    sizes = {g: (under, whole - under) for g, under, whole in counted.groupBy(group).agg(below, F.sum("n")).collect()}
    inside = {g: tuple(w - sizes.get(g, (0, 0))[0] for w in wanted[g]) for g in brackets}
    held = {g: r for g, r in inside.items() if r[0] >= 0 and r[1] < sizes.get(g, (0, 0))[1]}
    missed = {g: (-math.inf, math.inf) for g in brackets if g not in held}
    found: dict[int, tuple[float, float]] = {}
    if held:
        part = rows.join(few, group).filter(F.col("value").between(F.col("low"), F.col("high"))).select(group, "value")
        part = materialize(part.filter(F.col(group).isin(list(held))))
        off, ranks = margin(sketch), []
        for g, (i, j) in held.items():
            n = sizes[g][1]
            ranks += [max(0.0, i / n - off), min(1.0, (j + 1) / n + off)]
        values = _sketched(part, group, ranks, sketch)
        closer = {g: (values[g][1][2 * k], values[g][1][2 * k + 1]) for k, g in enumerate(held)}
        if all(closer[g] == brackets[g] for g in held):  # a margin wider than the group: no sketch brings it closer
            settle_rows = 2 * settle_rows
        found = _ranked(part, group, held, closer, sketch, settle_rows)
    return found | _ranked(rows, group, wanted, missed, sketch, settle_rows)
