"""Boilerplate lines by distinct-site spread: merged sketches, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import same_row, text_key, whole_text
from barwatch.session import materialize

LG_K = 12
BAND = 0.1
"""Half-width of the recount band as a share of the threshold: six standard errors at ``LG_K``."""


def line_rows(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """(_id, _tk, _site, _pos, _a, _b) for every line that has a character other than white space.

    ``_a`` and ``_b`` are two 64-bit hashes of the line, trimmed.
    """
    lines = docs.select(
        F.col(doc_id).alias("_id"),
        text_key(text).alias("_tk"),
        F.coalesce(F.col(site).cast("string"), F.lit("")).alias("_site"),
        F.posexplode(F.split(whole_text(text), "\n", -1)).alias("_pos", "_line"),
    ).withColumn("_line", F.btrim("_line", F.lit(" \t\r\x0b\x0c")))
    return lines.filter("_line != ''").select(
        "_id", "_tk", "_site", "_pos", F.xxhash64("_line").alias("_a"), F.xxhash64(F.lit(1), "_line").alias("_b")
    )


def widespread_lines(lines: DataFrame, min_sites: int) -> DataFrame:
    """Line hashes (_a, _b) that occur on at least ``min_sites`` distinct sites.

    One HyperLogLog sketch per line hash, built per task and merged, estimates the spread. Lines
    whose estimate is within ``BAND`` of the threshold are counted exactly, so only lines far from
    it rest on the estimate.
    """
    spread = materialize(
        lines.groupBy("_a", "_b")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LG_K))).alias("_sites"))
        .filter(F.col("_sites") >= int(min_sites * (1 - BAND)))
    )
    upper = min_sites * (1 + BAND) + 1
    near = spread.filter(F.col("_sites") <= upper).select("_a", "_b")
    exact = (
        lines.join(near, ["_a", "_b"], "left_semi")
        .select("_a", "_b", "_site").distinct()
        .groupBy("_a", "_b").agg(F.count("*").alias("_n"))
        .filter(F.col("_n") >= min_sites)
    )
    return spread.filter(F.col("_sites") > upper).select("_a", "_b").unionByName(exact.select("_a", "_b"))


def remove_boilerplate(
    docs: DataFrame, min_sites: int = 10, doc_id: str = "doc_id", text: str = "text", site: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines long, n_removed long, kept_text.

    Every line found on at least ``min_sites`` distinct sites is removed from all documents. Lines
    compare trimmed; lines of white space only are never removed. A null site counts as the empty one;
    a null or empty text has one empty line and stays empty. Rows that repeat id and text are
    treated alike. Other columns are ignored; an empty table gives an empty result.
    """
    lines = line_rows(docs, doc_id, text, site)
    wide = materialize(widespread_lines(lines, min_sites))
    removed = (
        lines.select("_id", "_tk", "_pos", "_a", "_b").join(wide, ["_a", "_b"])
        .groupBy("_id", "_tk").agg(F.collect_set("_pos").alias("_gone"))
    )
    whole = docs.select(F.col(doc_id).alias("_id"), text_key(text).alias("_tk"), whole_text(text).alias("_text"))
    gone = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    split = F.split("_text", "\n", -1)
    kept = F.when(F.size(gone) == 0, F.col("_text")).otherwise(
        F.array_join(F.filter(split, lambda _, i: ~F.array_contains(gone, i)), "\n")
    )
    return whole.join(removed, same_row(whole, removed), "left").select(
        whole["_id"].alias("doc_id"),
        F.size(split).cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_removed"),
        kept.alias("kept_text"),
    )
