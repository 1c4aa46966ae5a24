"""The corpus pipeline: identify languages, remove copies, near copies and repeated passages, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barwatch.llm.common import read_table
from barwatch.llm.exact_dedup import drop_exact
from barwatch.llm.language import keep_identified
from barwatch.llm.near_dedup import drop_near
from barwatch.llm.packing import pack
from barwatch.llm.queries import tokenizer_path
from barwatch.llm.substring_dedup import drop_passages
from barwatch.session import materialize


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that no language claims, and those without a letter."""
    return keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per content."""
    return drop_exact(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per class of near copies."""
    return drop_near(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that a document with a smaller id has; documents of which nothing is left go."""
    return drop_passages(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full token windows, with checksums of their ids."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("language", identify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("packing", pack_windows),
]

ORACLE_SQL = None
"""SQL has neither the regression nor the packing; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's result written to the shared folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
