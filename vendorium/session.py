"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Settings every job relies on. The rest is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM interprets methods of more than 8,000 bytes and never compiles them. Beyond that many, wide expressions are
    # generated in pieces in place of one method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: str = "8", **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster supplies its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vendorium")
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        **SETTINGS,
    }
    for key, value in {**defaults, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _temporary(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"vendorium-{application}-")


def scratch_root(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names; a temporary one only for local sessions without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _temporary(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/vendorium/{app}/{label}-{uuid.uuid4().hex}"


_written: ContextVar[list[str] | None] = ContextVar("_written", default=None)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def discarding_scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what `materialize` writes inside the block when it ends, so a long job does not pile it up."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield
    finally:
        _written.reset(token)
        for path in paths:
            delete_folder(spark, path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def releasing_shuffles(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of what runs inside the block are deleted with the end of each write or read, not when the driver
    happens to collect garbage: a long job would pile up a copy of all rows for each of its shuffles."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def same_splits(spark: SparkSession) -> AbstractContextManager[None]:
    """Files that are read more than once inside the block are cut into the same splits each time, also if executors
    come or go meanwhile: the size of splits depends on the number of cores."""
    return _setting(spark, "spark.sql.files.minPartitionNum", _least_splits(spark))


def _least_splits(spark: SparkSession) -> str:
    """What Spark would take at this moment."""
    chosen = [spark.conf.get(key, None) for key in ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism")]
    return next((one for one in chosen if one is not None), str(spark.sparkContext.defaultParallelism))


def materialize(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write `df` as Parquet to shared storage and read it back; with `keep` it outlives `discarding_scratch`.

    Unlike a cache it survives lost executors, and unlike an RDD checkpoint it
    keeps column pruning and gives the planner a real size for join choices.
    """
    path = scratch_path(df.sparkSession, label)
    if (paths := _written.get()) is not None and not keep:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str, most_rows: int | None = None) -> DataFrame:
    """Give every core a share of an input with fewer splits than cores; large inputs stay as they are.

    With `most_rows` a table is dealt into tasks of about so many rows at most, for work that keeps a task's rows in
    memory. Rows are counted from the file's metadata.
    """
    shares = df.sparkSession.sparkContext.defaultParallelism
    if most_rows is not None:
        shares = max(shares, -(-df.count() // most_rows))
    return df.repartition(shares, key) if df.rdd.getNumPartitions() < shares else df


@cache
def _table_schema(spark: SparkSession, path: str) -> StructType:
    return spark.read.parquet(path).schema


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; its schema is taken from the file once per session, not once per query."""
    return spark.read.schema(_table_schema(spark, path)).parquet(path)
