"""Token counts through a digest cache.

Counts are kept by (tokenizer version digest, content digest). Known contents
are answered by a join; only distinct contents that miss are encoded, and their
counts are appended to the cache for the next run.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from ledgerlink.llm.byte_bpe import LARGEST_FILE, REMEMBERED, small_batches

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens bigint"


class TokenCounter:
    """Counts the tokens of whole texts as the tokenizer file's library does.

    Byte-level files split a text by a fixed pattern before merging, so the
    count of a text is the sum of its pre-tokens' counts; those are encoded
    once and remembered. Added tokens cut the text first and count as one
    each. For any other kind of file whole texts are encoded.
    """

    def __init__(self, file: bytes, pattern: str):
        self._tokenizer = Tokenizer.from_str(file.decode())
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._known: dict[str, int] = {}
        added = list(self._tokenizer.get_added_tokens_decoder().values())
        plain = all(not (a.lstrip or a.rstrip or a.single_word or a.normalized) for a in added)
        cut = self._tokenizer.pre_tokenizer
        byte_level = isinstance(cut, ByteLevel) and not cut.add_prefix_space and cut.use_regex
        self._by_parts = bool(plain and byte_level and self._tokenizer.normalizer is None)
        self._split = regex.compile(pattern).findall
        names = sorted((a.content for a in added), key=len, reverse=True)
        self._cut = re.compile("|".join(map(re.escape, names))).split if names else lambda text: [text]

    def _new(self, parts: list[str]) -> None:
        found = self._tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        self._known.update((p, len(e)) for p, e in zip(parts, found, strict=True))

    def count(self, text: str) -> int:
        if not self._by_parts:
            return len(self._tokenizer.encode(text, add_special_tokens=False))
        pieces = self._cut(text)
        total = len(pieces) - 1
        if len(self._known) > REMEMBERED:
            self._known.clear()
        known = self._known
        for piece in pieces:
            parts = self._split(piece)
            new = set(parts).difference(known)
            if new:
                self._new(list(new))
            total += sum(map(known.__getitem__, parts))
        return total


_workers: dict[str, TokenCounter] = {}


def tokenizer_version(path: str, pattern: str) -> tuple[str, bytes]:
    """(digest, content) of a tokenizer file; the digest also covers the pattern."""
    with open(path, "rb") as file:
        data = file.read(LARGEST_FILE + 1)
    if len(data) > LARGEST_FILE:
        raise ValueError(f"{path} is larger than {LARGEST_FILE} bytes")
    return hashlib.sha256(data + pattern.encode()).hexdigest(), data


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for a tokenizer version; repeated digests count once."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], CACHE_SCHEMA).select("digest", "n_tokens")
    rows = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encoded(misses: DataFrame, version: str, data: bytes, pattern: str) -> DataFrame:
    shared = misses.sparkSession.sparkContext.broadcast((version, data, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, data, pattern = shared.value
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread, as Spark counts it
        if version not in _workers:
            _workers.clear()
            _workers[version] = TokenCounter(data, pattern)
        counter = _workers[version]
        for batch in batches:
            for part in small_batches(batch, "text"):
                counts = [counter.count(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([version] * len(counts)), part.column("digest"), pa.array(counts, pa.int64())],
                    names=["tokenizer", "digest", "n_tokens"],
                )

    return misses.mapInArrow(run, CACHE_SCHEMA)


def count_tokens(docs: DataFrame, path: str, pattern: str, cache: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row; ``cache`` grows by the misses.

    Normalised content is the text itself, with null as the empty text, because
    any other change could change the count. Copies collapse before the shuffle,
    one text per task and content. Cache files are only ever added; a repeated
    write after a lost task counts once when read.
    """
    spark = docs.sparkSession
    version, data = tokenizer_version(path, pattern)
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", content.alias("text"))
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    known = read_cache(spark, cache, version)
    texts = rows.select(digest, "text")
    misses = (
        texts.join(known, "digest", "left_anti")
        .groupBy("digest").agg(F.first("text").alias("text"))
    )
    _encoded(misses, version, data, pattern).write.mode("append").parquet(cache)
    counts = read_cache(spark, cache, version)
    return (
        rows.select("doc_id", digest, F.octet_length("text").cast("long").alias("n_bytes"))
        .join(counts, "digest", "left")
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )


