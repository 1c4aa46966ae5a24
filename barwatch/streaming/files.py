"""Folders of arriving files as streams, and drained queries as tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


FILE_ROWS = 1_000_000
"""Rows of a delivered file, about: some 50 MB, which one task writes."""


def deliver(rows: DataFrame, folder: str, files: int = 1) -> None:
    """Add ``rows`` to ``folder`` as ``files`` files that arrive now, or fewer where there are not rows for all.

    Rows are read by all tasks and dealt to the files.
    """
    rows.repartition(files).write.mode("append").parquet(folder)


def deliver_in_pieces(
    rows: DataFrame, folder: str, arrival: Column, ends: Sequence[dt.datetime], file_rows: int = FILE_ROWS
) -> int:
    """Deliver ``rows`` one piece after the other: those that arrive before each of ``ends``, then the rest.

    Rows without an arrival come last. Every piece is as many files as the returned number, of about ``file_rows`` rows in
    the largest one, so a stream that takes so many files per batch has a piece in each. What short pieces lack is
    made up by empty files.
    """
    begin, pieces = None, []
    for end in [*ends, None]:
        piece = F.lit(True) if begin is None else F.coalesce(arrival >= F.lit(begin), F.lit(True))
        if end is not None:
            piece = piece & F.coalesce(arrival < F.lit(end), F.lit(False))
        pieces.append(piece)
        begin = end
    sizes = rows.agg(*[F.count_if(piece) for piece in pieces]).first()
    files = max(1, -(-max(sizes) // file_rows))
    present = 0
    for nth, piece in enumerate(pieces, 1):
        deliver(rows.filter(piece), folder, files)
        present = _files(rows, folder, present)
        while present < nth * files:
            deliver(rows.limit(0), folder)
            present = _files(rows, folder, present)
    return files


def _files(rows: DataFrame, folder: str, before: int) -> int:
    """How many files ``folder`` has, which must be more than ``before``."""
    found = len(rows.sparkSession.read.schema(rows.schema).parquet(folder).inputFiles())
    if found <= before:
        raise RuntimeError(f"nothing was delivered to {folder}")
    return found


def deliver_marker(spark: SparkSession, folder: str, schema: StructType, time: str, at: dt.datetime) -> None:
    """Deliver one row that has nothing but its time, so that the watermark passes all rows before it.

    With ``at`` beyond the last row by more than the watermark's delay and every window, all windows of real
    rows close, and the one that holds the marker never does.
    """
    row = {f.name: at if f.name == time else None for f in schema}
    nullable = StructType([type(f)(f.name, f.dataType, True) for f in schema])
    deliver(spark.createDataFrame([tuple(row[f.name] for f in schema)], nullable), folder)


def file_stream(spark: SparkSession, folder: str, schema: StructType, files_per_batch: int = 1) -> DataFrame:
    """The rows of a folder in the order in which its files arrived.

    The order within a batch is open, and so is the order of rows between batches as far as files overlap in
    time: a watermark's delay has to cover that. Pieces of several files each (``deliver_in_pieces``) are read with
    ``files_per_batch`` set to their number.
    """
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


@dataclass
class Drained:
    """What a drained query has written so far, and how this run went."""

    table: DataFrame
    batches: int
    dropped: int
    """Rows that came behind the watermark and were left out, in this run. A batch's rows are held against the
    watermark that the batch before it worked with."""


def drain(result: DataFrame, out: str, checkpoint: str) -> Drained:
    """Run a streaming query over all files that are there, in append mode, into the table ``out``.

    Progress and state live in ``checkpoint``: a later call with the same two folders goes on where this one
    ended, also after a failure, and each result row is written once. What is still open (windows, buffered rows) stays in
    the state until later files move the watermark.
    """
    spark = result.sparkSession
    query = (
        result.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
    try:
        query.awaitTermination()
        steps = query.recentProgress
    finally:
        query.stop()
    dropped = sum(s.numRowsDroppedByWatermark for p in steps for s in p.stateOperators)
    return Drained(spark.read.schema(result.schema).parquet(out), len(steps), dropped)
