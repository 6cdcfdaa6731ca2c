"""One row per key: the last one in load order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

# Load order, newest first. The hash only decides between rows that share a file position.
NEWEST_FIRST = ("load_ts", "source_file_name", "source_row_number", "record_hash")


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = ("supplier_id",), order: Sequence[str] = NEWEST_FIRST
) -> DataFrame:
    """Keep the last row of each key.

    `row_number() = 1` lets Spark put a group limit in front of the shuffle, so each
    task sends at most one row per key and a hot key arrives already reduced. Rows are sorted by a
    hash of their key first: numbers are told apart at once, texts that begin alike are not.
    """
    newest = Window.partitionBy("_key", *keys).orderBy(*[F.desc(name) for name in order])
    keyed = df.withColumn("_key", F.xxhash64(*keys))
    return keyed.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn", "_key")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; empty where the declared key holds."""
    return df.groupBy(*keys).agg(F.count("*").alias("occurrences")).filter("occurrences > 1")


def newest_raw_first(raw: DataFrame) -> DataFrame:
    """All raw rows, newest load first, then by file position."""
    return raw.orderBy(F.desc("_load_ts"), "_source_file_name", "_source_row_number")
