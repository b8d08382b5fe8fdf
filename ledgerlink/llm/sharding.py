"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every (key, shard) pair gets a score, and a key lives in the shard of its
highest score. Scores do not depend on the other shards, so a new shard takes
only the keys it wins and a removed shard gives up only its own: about one key
in n moves. With weights w the score is ``-w / ln(u)`` of the pair's uniform
number u, which gives each shard its share of the total weight.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlink.llm.common import partitions_for

#: Rows numbered together when slots are dealt out.
SLOT_ROWS = 20_000


def rendezvous_score(key_hash: Column, shard: Column, weight: Column) -> Column:
    """The score of a hashed key for a shard; a larger weight wins more often."""
    bits = F.shiftrightunsigned(F.xxhash64(key_hash, shard), 11)
    uniform = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    return -weight / F.ln(uniform)


def _best(key_hash: Column, weights: Mapping[int, float]) -> Column:
    """(score, -shard) of the winner; equal scores go to the smaller shard."""
    shards = F.array(*[
        F.struct(F.lit(int(s)).alias("shard"), F.lit(float(w)).alias("weight"))
        for s, w in weights.items()
    ])
    return F.array_max(
        F.transform(
            shards,
            lambda s: F.struct(
                rendezvous_score(key_hash, s["shard"], s["weight"]).alias("score"),
                (-s["shard"]).alias("negative"),
            ),
        )
    )


def shard_by_key(
    docs: DataFrame,
    weights: Mapping[int, float],
    grown: Mapping[int, float] | None = None,
    key: str = "doc_id",
) -> DataFrame:
    """Add ``shard`` and ``grown_shard`` (the shard if those of ``grown`` join) to ``docs``.

    The key is hashed as text, so its integer width does not matter. Rows with
    equal keys share a shard; all null keys count as one key. One projection,
    no shuffle. Column names of the result win over those of the input.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("shards need positive weights")
    hashed = F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("\0null")))
    rows = docs.withColumn("_hash", hashed).withColumn("_best", _best(F.col("_hash"), weights))
    rows = rows.withColumn("shard", -F.col("_best.negative"))
    if grown:
        rows = rows.withColumn("_grown", _best(F.col("_hash"), grown)).withColumn(
            "grown_shard",
            F.when(F.col("_grown.score") > F.col("_best.score"), -F.col("_grown.negative"))
            .otherwise(F.col("shard")),
        ).drop("_grown")
    else:
        rows = rows.withColumn("grown_shard", F.lit(None).cast("int"))
    return rows.drop("_hash", "_best")


def slots(rows: DataFrame, order: str, spread: Column, total: int) -> DataFrame:
    """Number the rows of every ``shard`` from 0 without gaps (``slot``).

    A shard is cut into buckets by the hash ``spread``, so no task sorts a
    whole shard. Bucket sizes come from a count with map-side combine; their
    running sums, one row per bucket, join back to the rows, which are shuffled
    once. Rows of one bucket are numbered by ``order``, then by ``spread``.
    """
    per_shard = partitions_for(total, SLOT_ROWS)
    cut = rows.withColumn("_bucket", F.pmod(spread, F.lit(per_shard)).cast("int"))
    sizes = cut.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("shard").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = W.partitionBy("shard", "_bucket").orderBy(order, spread)
    return (
        cut.withColumn("_rank", F.row_number().over(inside))
        .join(starts, ["shard", "_bucket"])
        .withColumn("slot", F.col("_start") + F.col("_rank") - 1)
        .drop("_bucket", "_rank", "_start")
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """The documents dealt to equal shards 0 to ``shards`` - 1 under the law ``key``.

    One row per input row: doc_id, size (UTF-8 bytes plus 16; a null text has
    none), text_crc32, law, shard, slot, grown_shard. A null text has the
    checksum of the empty text. Buckets of a shard are cut by id and text, so
    null and repeated ids spread; wholly equal rows stay together. An empty
    table gives an empty result.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    dealt = shard_by_key(rows, {s: 1.0 for s in range(shards)}, {shards: 1.0})
    spread = F.xxhash64("doc_id", "text_crc32", "size")
    total = docs.select("doc_id").count()
    return slots(dealt, "doc_id", spread, total // shards + 1).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"),
        "grown_shard",
    )
