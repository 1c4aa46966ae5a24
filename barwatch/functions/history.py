"""Bounded groups for trailing windows: long histories cut into overlapping pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECE = "_piece"
CARRIED = "_carried"


def cut_history(
    rows: DataFrame, key: str, date: str, lookback: int, piece_rows: int
) -> DataFrame:
    """Number every key's rows by date and cut them into pieces of ``piece_rows`` rows.

    The last ``lookback`` rows of a piece are repeated at the head of the next one, marked
    ``_carried``, so a window over (key, ``_piece``) sees the same past as a window over the
    whole key. No group grows with the history of one key: numbering goes by (key, year), whose
    rows the calendar bounds, and the offsets are sums over one row per (key, year).
    """
    if piece_rows < lookback:
        raise ValueError("piece_rows must be at least the lookback")
    dated = rows.withColumn("_year", F.year(date))
    by_year = Window.partitionBy(key, "_year").orderBy(date)
    numbered = dated.withColumn("_nth", F.row_number().over(by_year))

    earlier_years = (
        Window.partitionBy(key).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        dated.groupBy(key, "_year")
        .count()
        .select(
            key,
            "_year",
            F.coalesce(F.sum("count").over(earlier_years), F.lit(0)).alias("_before"),
        )
    )
    position = F.col("_before") + F.col("_nth") - 1
    tail = position % piece_rows >= piece_rows - lookback
    home = F.floor(position / piece_rows)
    places = F.when(tail, F.array(home, home + 1)).otherwise(F.array(home))
    return (
        numbered.join(offsets, [key, "_year"])
        .withColumn("_home", home)
        .withColumn(PIECE, F.explode(places))
        .withColumn(CARRIED, F.col(PIECE) > F.col("_home"))
        .drop("_year", "_nth", "_before", "_home")
    )


def own_rows(pieces: DataFrame) -> DataFrame:
    """Drop the carried copies again."""
    return pieces.filter(~F.col(CARRIED)).drop(PIECE, CARRIED)
