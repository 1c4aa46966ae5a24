"""Rank of a value among many past rows, with memory bounded by the window and not by rows times window."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from barwatch.functions.history import CARRIED, PIECE, cut_history
from barwatch.functions.ranks import counts_at_most
from barwatch.session import ship_package


def trailing_rank(rows: DataFrame, key: str, date: str, value: str, window: int, name: str) -> DataFrame:
    """``rows`` with a column ``name``: the share of the past ``window`` rows of the key with a value at most this one.

    As ``trailing_share_at_most``: null until ``window`` rows have passed, missing past values (null or
    NaN) count as above and a missing current one scores 0. (key, date) has to be unique.

    Histories are cut into blocks of ``window`` rows, each of which meets the block before it in one
    task: twice the window at most, however long the history of a key. Blocks of one key are spread
    over tasks. A key's first block has no past and is not sent through Python.
    """
    if window < 1:
        raise ValueError("window must be positive")
    ship_package(rows.sparkSession)
    shape = StructType([*rows.schema.fields, StructField(name, DoubleType())])
    kept = rows.columns

    def ranked(piece: pa.Table) -> pa.Table:
        piece = piece.sort_by(date)
        carried = pc.sum(piece[CARRIED]).as_py() or 0
        values = piece[value].cast(pa.float64()).to_numpy().astype(float)
        share = counts_at_most(values, window, carried) / float(window)
        own = piece.slice(carried).select(kept)
        return own.append_column(name, pa.array(np.asarray(share), pa.float64()))

    pieces = cut_history(rows, key, date, window, window)
    later = pieces.filter(F.col(PIECE) > 0).groupBy(key, PIECE).applyInArrow(ranked, shape)
    early = pieces.filter((F.col(PIECE) == 0) & ~F.col(CARRIED)).select(*kept, F.lit(None).cast("double").alias(name))
    return early.unionByName(later)
