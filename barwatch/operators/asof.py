"""As-of join: each left row with the latest right row of its keys at or before its time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwatch.session import broadcast_if_small, materialize

SLICE_ROWS = 2_000_000
"""Rows of one key, of both sides, beyond which its time is cut into slices of about so many."""

BUCKET_SECONDS = 86_400
"""Slices are made of whole buckets of this length."""


def _known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*keys, "_time"]])


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    inclusive: bool = True,
    within: Column | None = None,
    slice_rows: int = SLICE_ROWS,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """All rows and columns of ``left``, with ``values`` of the matching right row, null where there is none.

    A match has the same ``by`` columns and the latest time at or before the left row's (before it, if not
    ``inclusive``), no earlier than that by more than the interval ``within``. Of several right rows at that
    time the one with the greatest ``values``, compared in order, matches. Times are dates or timestamps; null
    keys and times match nothing.

    Both sides meet tagged in one sort by (keys, time) and the last right row is carried forward, so no pair that is
    not in the result is ever made. Keys with more than ``slice_rows`` rows are cut along time, and each slice begins
    with the last right row before it. Times of one bucket stay together.
    """
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    keys = [f"_key{i}" for i in range(len(by))]
    own = [F.col(b).alias(k) for b, k in zip(by, keys)]
    match = F.struct(F.col(right_time).cast("timestamp").alias("at"), F.struct(*values).alias("values"))
    there = right.select(*own, F.col(right_time).cast("timestamp").alias("_time"), match.alias("_match")).filter(_known(keys))
    kind = there.schema["_match"].dataType
    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    here = left.select(*own, F.col(left_time).cast("timestamp").alias("_time"), row.alias("_row"))
    # At equal times right rows come first where they count, else behind.
    tagged = here.filter(_known(keys)).select(*keys, "_time", F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_match"), "_row")
    none = F.lit(None).cast(tagged.schema["_row"].dataType).alias("_row")
    both = tagged.unionByName(there.select(*keys, "_time", F.lit(0 if inclusive else 2).alias("_side"), "_match", none))

    hot = materialize(both.groupBy(*keys).count().filter(F.col("count") > slice_rows).drop("count"))
    if hot.isEmpty():
        both = both.withColumn("_slice", F.lit(0).cast("long"))
    else:
        both = _sliced(both, hot, keys, slice_rows, bucket_seconds)
    order = Window.partitionBy(*keys, "_slice").orderBy("_time", "_side", "_match")
    carried = F.last("_match", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    matched = both.withColumn("_match", carried).filter("_side = 1")
    if within is not None:
        near = F.col("_match.at") + within >= F.col("_time")
        matched = matched.withColumn("_match", F.when(near, F.col("_match")))
    apart = here.filter(~_known(keys)).select("_row", F.lit(None).cast(kind).alias("_match"))
    out = matched.select("_row", "_match").unionByName(apart)
    return out.select("_row.*", *[F.col(f"_match.values.{v}").alias(v) for v in values])


def _sliced(both: DataFrame, hot: DataFrame, keys: list[str], slice_rows: int, bucket_seconds: int) -> DataFrame:
    """Rows with ``_slice``, and before each slice of a hot key the last right row of the earlier ones."""
    bucket = F.floor(F.unix_seconds("_time") / bucket_seconds)
    both = both.withColumn("_bucket", bucket)
    counts = both.join(broadcast_if_small(hot), keys, "left_semi").groupBy(*keys, "_bucket").count()
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    slice_of = F.floor(F.coalesce(F.sum("count").over(before), F.lit(0)) / slice_rows)
    slices = materialize(counts.select(*keys, "_bucket", slice_of.alias("_slice")))

    few = broadcast_if_small(slices)
    lasts = both.filter("_side <> 1").join(few, [*keys, "_bucket"])
    lasts = lasts.groupBy(*keys, "_slice").agg(F.max("_match").alias("_match"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = (
        slices.select(*keys, "_slice").distinct().join(lasts, [*keys, "_slice"], "left")
        .withColumn("_match", F.last("_match", ignorenulls=True).over(earlier))
        .filter(F.col("_match").isNotNull())
    )
    # A null time sorts before all others.
    first = begins.select(
        *keys,
        F.lit(None).cast("timestamp").alias("_time"),
        F.lit(0).alias("_side"),
        "_match",
        F.lit(None).cast(both.schema["_row"].dataType).alias("_row"),
        "_slice",
    )
    placed = both.join(few, [*keys, "_bucket"], "left").withColumn("_slice", F.coalesce("_slice", F.lit(0)))
    return placed.drop("_bucket").unionByName(first)
