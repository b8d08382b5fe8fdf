"""The named queries of this subpackage; each has the form (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import (
    byte_bpe,
    decontaminate,
    embedding_dedup,
    fill_middle,
    html_extract,
    lz_dedup,
    minhash_dedup,
    quality,
    sharding,
    suffix_dedup,
    token_counts,
    url_filter,
    vector_codes,
)
from ledgerlink.llm.common import table, work_folder

QUERIES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40)


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digests(table(spark, sf_dir, "documents"))


@query
def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoding_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so that a run never rests on an earlier one."""
    import uuid

    cache = f"{work_folder(spark)}/token-cache-{uuid.uuid4().hex}"
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, cache)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op9_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_dedup.dedup_digests(table(spark, sf_dir, "documents"))


@query
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_digests(table(spark, sf_dir, "embeddings"))


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fim_digests(table(spark, sf_dir, "documents"))


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))
