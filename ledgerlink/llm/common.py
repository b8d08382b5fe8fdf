"""Shared by the operators: written intermediate tables, document keys, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlink.session import checkpoint_folder

_FOLDER = "ledgerlink-llm"


def work_folder(spark: SparkSession) -> str:
    """A folder of this application inside the shared checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{_FOLDER}-{spark.sparkContext.applicationId}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from the files.

    The files outlive executors: what comes later never recomputes what came
    before. :func:`drop_saved` removes them when the results have been stored.
    """
    path = f"{work_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_saved(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; earlier results must be stored by then."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text), one row per key that is not null.

    Rows that repeat a key are one document with the smallest of their texts
    (null sorts last). Other columns are ignored, so their names never clash.
    Repeats are looked for on the key column alone; only if there are any are
    the texts shuffled.
    """
    rows = docs.select(F.col(key), F.col(text)).where(F.col(key).isNotNull())
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return rows
    return rows.groupBy(key).agg(F.min(text).alias(text))


def one_row_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row per key, the one that :func:`keyed_texts` takes the text of; all rows without key.

    Among rows of equal text the smallest hash of the other columns decides.
    Only if a key repeats are the rows shuffled, combined before that.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    repeated = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return docs
    plain = [F.col(f"`{f.name}`") for f in docs.schema if f.dataType.typeName() not in ("map", "variant")]
    order = F.struct(F.col(text).isNull(), F.col(text), F.xxhash64(*plain))
    one = docs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.min_by(F.struct(*columns), order).alias("row")
    )
    return one.select("row.*").unionByName(docs.where(F.col(key).isNull()))


def partitions_for(rows: int, per_partition: int, least: int = 1) -> int:
    """How many partitions hold ``rows``; grows with the data."""
    return max(least, -(-rows // per_partition))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the undirected ``edges``.

    Alternating large and small stars: every node hands the smallest neighbour
    to its larger, then to its smaller neighbours, until nothing changes, which
    takes a logarithmic number of rounds. Each round is aggregations with
    map-side combine and a join on the node that adaptive execution can split,
    so a hub of a third of all nodes is no one task's work. Edges of a node to
    itself and repeated edges do no harm; no edges give an empty table.
    """
    links = saved(
        edges.select(
            F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")
        ).where("hi <> lo").distinct(),
        "edges",
    )
    before = None
    while True:
        links = saved(_small_star(_large_star(links)), "edges")
        after = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
        if after == before:
            break
        before = after
    # every remaining link is (node, smallest node of its component)
    return links.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("component")).union(
        links.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        .where("hi <> lo").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("hi").alias("u")).agg(F.min("lo").alias("m"))
    moved = (
        links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).join(least, "u")
        .select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    )
    kept = least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
    return moved.where("hi <> lo").union(kept).distinct()


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
