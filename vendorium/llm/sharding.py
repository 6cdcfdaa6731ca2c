"""Reproducible shuffle into shards by a keyed permutation of row numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from vendorium.llm.scratch import fresh_name
from vendorium.llm.shipping import ship
from vendorium.llm.words import mix
from vendorium.operators.numbering import number_rows

SHARDS = 16
SEED = 20_240_607
ROUNDS = 6


def _keys(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, ROUNDS, dtype=np.uint64)


def _half_bits(rows: int) -> int:
    return max(1, -(-max(1, rows - 1).bit_length() // 2))


def _network(values: np.ndarray, half: np.uint64, keys: np.ndarray) -> np.ndarray:
    mask = (np.uint64(1) << half) - np.uint64(1)
    left, right = values >> half, values & mask
    for key in keys:
        left, right = right, left ^ (mix(right + key) & mask)
    return (left << half) | right


def permute(numbers: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """Where row numbers 0..rows-1 go: a Feistel network over the next even power of two, and cycle walking.

    A value outside 0..rows-1 is sent through again until it falls inside; a cycle that starts inside comes back
    inside, so this ends, after fewer than four passes on average.
    """
    half, keys = np.uint64(_half_bits(rows)), _keys(seed)
    places = _network(numbers.astype(np.uint64), half, keys)
    outside = np.flatnonzero(places >= rows)
    while len(outside):
        places[outside] = _network(places[outside], half, keys)
        outside = outside[places[outside] >= rows]
    return places.astype(np.int64)


def unpermute(places: np.ndarray, rows: int, seed: int = SEED) -> np.ndarray:
    """The row numbers that `permute` sends to these places: which row is at a shard and slot is computable too."""
    half, keys = np.uint64(_half_bits(rows)), _keys(seed)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def back(values: np.ndarray) -> np.ndarray:
        left, right = values >> half, values & mask
        for key in keys[::-1]:
            left, right = right ^ (mix(left + key) & mask), left
        return (left << half) | right

    numbers = back(places.astype(np.uint64))
    outside = np.flatnonzero(numbers >= rows)
    while len(outside):
        numbers[outside] = back(numbers[outside])
        outside = outside[numbers[outside] >= rows]
    return numbers.astype(np.int64)


def assign_shards(numbered: DataFrame, number: str, rows: int, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Add `shard` and `slot` from the row number: place modulo shards, place divided by shards.

    Counts differ by one row at most and slots have no gaps. Nothing moves. Columns of these names are replaced.
    """

    ship(numbered.sparkSession)

    @F.pandas_udf("long")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(np.int64), rows, seed))

    kept = [F.col(name) for name in numbered.columns if name.lower() not in ("shard", "slot")]
    at = fresh_name("_place", numbered.columns)
    placed = numbered.select(*kept, place(F.col(number)).alias(at))
    shard, slot = F.col(at) % shards, F.floor(F.col(at) / shards)
    return placed.select(*kept, shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def document_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Each document's shard and slot. Rows are numbered by (doc_id, size, crc32 of the text), null first, so the
    result does not depend on files or partitions; only these three columns are sorted, and the texts stay.

    The law is `rows`: shard sizes in rows differ by one at most. Every row has a place of its own, so equal texts
    are dealt out like any others and repeated rows take neighbouring numbers. Null and empty texts count one byte.
    """
    raw = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    # The last key spreads rows that are alike in all three, a third of all perhaps, over several ranges.
    keyed = narrow.withColumn("_alike", F.monotonically_increasing_id())
    numbered = number_rows(keyed, "_row", ("doc_id", "size", "text_crc32", "_alike"), after=-1).drop("_alike")
    placed = assign_shards(numbered, "_row", numbered.count(), shards, seed)
    law, grown = F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def write_shards(placed: DataFrame, path: str) -> None:
    """Write rows with their shard and slot: a folder for each shard, files in slot order, many tasks to a shard."""
    ordered = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ordered.write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))
