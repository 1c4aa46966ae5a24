"""Reproducible shuffle into shards: a keyed permutation of the global row numbers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import numbered_rows, whole_text
from barwatch.session import materialize

ROUNDS = 6


def sides(total: int) -> tuple[int, int]:
    """The sides of a near-square grid with at least ``total`` cells."""
    a = math.isqrt(max(total, 1) - 1) + 1
    return a, max(1, -(-total // a))


def feistel(rows: DataFrame, column: str, total: int, seed: int) -> DataFrame:
    """``column`` after one pass of a Feistel network over the cells of ``sides(total)``.

    Each round adds a keyed hash of one coordinate to the other, modulo its side. Every round, and
    with it the pass, is therefore a bijection of the grid, for any sides.
    """
    a, b = sides(total)
    rows = rows.withColumns({"_left": F.expr(f"{column} div {b}L"), "_right": F.expr(f"{column} % {b}L")})
    for turn in range(ROUNDS):
        moved, fixed, side = ("_right", "_left", b) if turn % 2 else ("_left", "_right", a)
        keyed = F.pmod(F.xxhash64(F.col(fixed), F.lit(seed), F.lit(turn)), F.lit(side))
        rows = rows.withColumn(moved, F.pmod(F.col(moved) + keyed, F.lit(side)).cast("long"))
    return rows.withColumn(column, F.col("_left") * F.lit(b) + F.col("_right")).drop("_left", "_right")


def permuted(rows: DataFrame, column: str, total: int, seed: int) -> DataFrame:
    """``column`` (numbers from 0 to total - 1) replaced by its place in a keyed permutation.

    Cycle walking: a number that falls on a spare cell is permuted again until it is below
    ``total``. The grid has at most 2 * sqrt(total) + 1 spare cells, so few rows walk on, and a walk
    ends because the pass is a bijection.
    """
    step = materialize(feistel(rows, column, total, seed))
    out = step.filter(F.col(column) < total)
    while not (outside := step.filter(F.col(column) >= total)).isEmpty():
        step = materialize(feistel(outside, column, total, seed))
        out = out.unionByName(step.filter(F.col(column) < total))
    return out


def shards(
    docs: DataFrame, n_shards: int, seed: int = 42, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Rows are numbered by id (null first, then by crc32 and size; rows that repeat all three are
    interchangeable) and permuted; the place modulo ``n_shards`` is the shard, the quotient the slot.
    So shard sizes in rows differ by one at most (law ``rows``), slots have no gaps, and shard and
    slot follow from row number, row count and seed alone. ``size`` is UTF-8 bytes plus 16; a null
    text has no bytes. ``grown_shard`` is null under this law. Other columns are ignored; an empty
    table gives an empty result. Only ids, sizes and checksums are shuffled, never texts.
    """
    rows = docs.select(
        F.col(doc_id).alias("_id"),
        (F.octet_length(whole_text(text)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(whole_text(text), "UTF-8")).alias("text_crc32"),
    )
    numbered, total = numbered_rows(rows, "_id", "text_crc32", "size")
    place = F.col("_row")
    return permuted(numbered, "_row", total, seed).select(
        F.col("_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        (place % n_shards).cast("int").alias("shard"),
        F.expr(f"_row div {n_shards}L").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
