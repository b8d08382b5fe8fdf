"""Spark session helpers: local sessions for tests and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Removes the shuffle files of an execution when it ends; else they stay until the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders written in the innermost :func:`passing_results`.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks.

    Its few shuffle partitions are one per core, so they are not merged further.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerlink")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate results.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session that names none gets a folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="ledgerlink-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it an execution leaves no shuffle files: its written result stands for them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


@contextmanager
def passing_results(spark: SparkSession) -> Iterator[None]:
    """What :func:`cut_lineage` and :func:`checkpointed` write within it is removed at its end.

    For steps whose own result is written as well; that goes through :func:`lasting`.
    """
    folders: list[str] = []
    token = _passing.set(folders)
    try:
        yield
    finally:
        _passing.reset(token)
        for folder in folders:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/written-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and continue from there.

    Used where a result feeds several consumers or an iteration. The files
    survive the loss of executors, so nothing before this point is recomputed,
    and the shuffle files that led to them are removed.
    They are Parquet: compressed, and read by the columns that are used.
    """
    written, path = _written(df)
    if (folders := _passing.get()) is not None:
        folders.append(path)
    return written


def lasting(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, but the files outlive :func:`passing_results`."""
    return _written(df)[0]


def checkpointed(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, with partitions and the order of their rows as they are."""
    checkpoint_folder(df.sparkSession)
    with _shuffles_removed(df.sparkSession):
        kept = df.select("*").checkpoint(eager=True)  # a new frame, as one made before keeps its shuffle files
    if (folders := _passing.get()) is not None:
        file = kept._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            folders.append(file.get())
    return kept
