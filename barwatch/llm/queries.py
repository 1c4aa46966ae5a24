"""One query per operator over the whole given tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwatch.llm import (
    bpe,
    clustering,
    embedding_dedup,
    exact_dedup,
    language,
    line_dedup,
    near_dedup,
    negatives,
    packing,
    quality_score,
    sharding,
    substring_dedup,
    token_files,
)
from barwatch.llm.common import read_table
from barwatch.session import new_folder

def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_links(read_table(spark, sf_dir, "embeddings"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_boilerplate(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("kept_text").alias("kept_md5"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(read_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_classes(read_table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read_table(spark, sf_dir, "documents"), 40)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark)
    docs = read_table(spark, sf_dir, "documents")
    token_files.write_token_files(docs, folder, tokenizer_path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, folder).drop("ids")


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_classes(read_table(spark, sf_dir, "documents")).drop("_node")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json")).drop("ids")


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.clusters(read_table(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_score.quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_dedup,
        op2_line_dedup,
        op3_language,
        op4_exact_dedup,
        op5_substring_dedup,
        op6_sharding,
        op7_bpe,
        op8_token_files,
        op9_near_dedup,
        op10_packing,
        op11_centroid_clustering,
        op12_quality,
        op13_hard_negatives,
    )
}
