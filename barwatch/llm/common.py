"""Column helpers and row numbering shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwatch.llm.textarrays import forget
from barwatch.session import materialize, ship_package

WHITE = " \t\n\x0b\x0c\r"
"""The characters that separate words and that content comparison ignores."""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def give_back() -> None:
    """Hand this worker's buffers, and memory that nothing uses any more, back to the system as far as the platform can."""
    forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def in_python(rows: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``rows.mapInArrow(function, schema)``, with this package sent to the executors first.

    Workers serve one task after the other, of any stage. What a task has freed is given back at its end, or every worker
    would stay as large as its largest task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, schema)


def grouped_rows(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows with the same first ``keys`` columns, which have to stand together."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    for key, some in groupby(rows, lambda r: r[:keys]):
        yield key, list(some)


def whole_text(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(name), F.lit(""))


def text_key(name: str = "text") -> Column:
    """Two 64-bit hashes of the text: with the id they tell rows apart that share an id."""
    return F.struct(
        F.xxhash64(whole_text(name)).alias("a"), F.xxhash64(F.lit(1), whole_text(name)).alias("b")
    )


def wrapped(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(_row, _id, _tk): whole rows beside their key, safe from columns of any names."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("_row"), F.col(doc_id).alias("_id"), text_key(text).alias("_tk"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on ``_id`` (null equals null) and ``_tk`` (`text_key`)."""
    return left["_id"].eqNullSafe(right["_id"]) & (left["_tk"] == right["_tk"])


def numbered_rows(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """``rows`` with consecutive long numbers ``_row`` from 0 in the given order, and their count.

    Range-sorted rows are stored with their partition and place; a partition's offset is the sum of
    the sizes before it. The offsets are one row per partition, which bounds the broadcast and the
    window. ``order`` has to cover all columns in which rows may differ, so that a recomputed
    partition numbers its rows alike.
    """
    placed = materialize(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(placed.groupBy(part.alias("_part")).count())
    total = sizes.agg(F.sum("count")).first()[0] or 0
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    out = (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_row", F.col("_before") + place)
        .drop("_place", "_part", "_before")
    )
    return out, total
