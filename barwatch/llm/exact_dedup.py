"""Exact duplicates by 128-bit content hash, with the bytes compared inside each hash group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwatch.llm.common import WHITE, whole_text, wrapped
from barwatch.session import materialize


def content(name: str = "text") -> Column:
    """The text without white space; null counts as empty."""
    out = whole_text(name)
    for character in WHITE:
        out = F.replace(out, F.lit(character), F.lit(""))
    return out


def collisions(docs: DataFrame, text: str, hashed: Callable[[Column], Column]) -> DataFrame:
    """Hashes (``_key``) that stand for more than one content.

    Grouping by (hash, content) compares the bytes. Copies meet in the map-side step, so a content
    is shuffled once per task at most, however many copies it has.
    """
    forms = docs.select(content(text).alias("_content")).withColumn("_key", hashed(F.col("_content")))
    return (
        forms.select("_key", "_content").distinct()
        .groupBy("_key").agg(F.count("*").alias("_n"))
        .filter("_n > 1").select("_key")
    )


def exact_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    hashed: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Of texts that are equal but for white space the row with the most code points stays, then the
    one with the smallest id (a null id comes last). Null and empty texts are equal. Rows that
    repeat id and text count in ``group_size`` and are marked alike; ``drop_exact`` keeps one of
    them. Other columns are ignored. An empty table gives an empty result.

    Hashes go with the ids as narrow rows; a group's choice is an aggregate with map-side combining.
    Where one hash stands for two contents, the content itself joins the group's key.
    """
    rows = docs.select(
        F.col(doc_id).alias("_id"), F.length(whole_text(text)).alias("_points"), content(text).alias("_content")
    ).select("_id", "_points", "_content", hashed(F.col("_content")).alias("_key"))
    sha = F.sha2("_content", 256).alias("_sha")
    clashes = materialize(collisions(docs, text, hashed))
    if clashes.isEmpty():
        narrow = rows.select("_id", "_points", "_key", sha, F.lit("").alias("_exact"))
    else:
        hit = clashes.withColumn("_hit", F.lit(True))
        exact = F.when(F.col("_hit"), F.col("_content")).otherwise("").alias("_exact")
        narrow = rows.join(hit, "_key", "left").select("_id", "_points", "_key", sha, exact)
    narrow = materialize(narrow)
    best = narrow.groupBy("_key", "_exact").agg(
        F.count("*").alias("_size"),
        F.min(F.struct((-F.col("_points")).alias("p"), F.col("_id").isNull().alias("n"), F.col("_id").alias("i"))).alias("_best"),
    )
    return narrow.join(best, ["_key", "_exact"]).select(
        F.col("_id").alias("doc_id"),
        F.col("_best.i").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_best.i")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that stay: one per content."""
    classes = materialize(exact_classes(docs, doc_id, text).filter("kept"))
    keep = classes.select(F.col("keep_id").alias("_keep"), F.col("text_sha256").alias("_sha"))
    rows = wrapped(docs, doc_id, text).withColumn("_own", F.sha2(content("_row." + text), 256))
    matched = rows["_id"].eqNullSafe(keep["_keep"]) & (rows["_own"] == keep["_sha"])
    staying = rows.join(keep.dropDuplicates(), matched, "left_semi")
    if not classes.groupBy("keep_id", "text_sha256").count().filter("count > 1").isEmpty():
        staying = staying.dropDuplicates(["_id", "_own"])  # rows that repeat id and content
    return staying.select("_row.*")
