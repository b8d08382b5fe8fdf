"""A training-data pipeline over ``documents``: quality, near and exact repeats, benchmarks, tokens.

Every stage takes (spark, docs, sf_dir), works on what its predecessor kept and
returns a DataFrame that is written as Parquet before the next stage reads it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.llm import byte_bpe, decontaminate, minhash_dedup, quality, suffix_dedup
from ledgerlink.llm.common import one_row_each, saved, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, trained on the labelled ones, takes for good."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id.

    Rows that repeat an id are one document, that of the smallest text, and one
    row of it stays. Rows without id all stay.
    """
    return minhash_dedup.one_of_each(docs)


def without_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated 100-byte strings; texts that held nothing else go.

    ``n_chars``, if there is such a column, follows the text, as every row states
    its own length. Empty and null texts stay as they are, as do rows without
    id; of rows that repeat an id the one with the smallest text stays.
    """
    docs = one_row_each(docs)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = {c: F.col("row").getField(f"c{i}") for i, c in enumerate(others)}
    row = F.struct(F.lit(0).alias("n"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("row")
    held |= {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    if "n_chars" in docs.columns:
        length = F.length("kept").cast(docs.schema["n_chars"].dataType)
        held["n_chars"] = F.when(F.col("text").eqNullSafe(F.col("kept")), held["n_chars"]).otherwise(length)
    emptied = (F.coalesce(F.length("text"), F.lit(0)) > 0) & (F.length("kept") == 0)
    kept = suffix_dedup.with_kept_texts(docs.select("doc_id", "text", row)).where(~emptied)
    return kept.select(*[held[c].alias(c) for c in docs.columns])


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.encoding_digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_quality),
    ("minhash near-dedup", one_of_near_copies),
    ("suffix-array dedup", without_repeated_bytes),
    ("benchmark decontamination", without_benchmarks),
    ("byte-level bpe", encoded),
]

#: The classifier and the signatures are beyond SQL; tests hold brute force against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
