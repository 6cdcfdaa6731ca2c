"""Exact top-k inner products on a bit-sliced index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vendorium.llm.scratch import Scratch
from vendorium.llm.shipping import ship
from vendorium.llm.vectors import by_dimension, is_usable

SCALE = 1024
K = 10
BLOCK_ROWS = 16_384  # rows of one index block
QUERY_ROWS = 2048  # queries that meet a block together
_INT64 = 2.0**63
_LEAST = -(2**63)


def _narrow(dims: int) -> float:
    """Quantised components below this fit 32 bits and can't overflow a score on slices."""
    return min(2.0**30, (2.0**59 / max(1, dims)) ** 0.5)


class Slices:
    """One block of rows: every bit of every component as a bitmap over the rows, in order of id."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, values = ids[order], values[order]
        self.low = values.min(axis=0)
        shifted = (values - self.low).astype(np.uint64)
        self.bits = max(1, int(shifted.max()).bit_length())
        words = -(-len(ids) // 64)
        packed = np.zeros((values.shape[1], self.bits, 8 * words), dtype=np.uint8)
        for bit in range(self.bits):
            rows = np.packbits(((shifted >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
            packed[:, bit, : len(rows)] = rows.T
        self._plain = packed.view(np.uint64).reshape(-1, words)
        self._maps = np.concatenate([self._plain, ~self._plain])
        self.valid = np.packbits(np.arange(64 * words) < len(ids), bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of the score's bits, lowest first, and a constant to add.

        The query's weights are taken bit by bit: a set bit adds the component's slices, moved up by as much. A
        negative weight adds the complement, so nothing is subtracted. Bitmaps of one place are added by full adders,
        three at a time, the carries going to the next place.
        """
        dims = len(query)
        size = np.abs(query)
        negative = query < 0
        constant = int((query * self.low).sum()) - int(size[negative].sum()) * ((1 << self.bits) - 1)
        taken: dict[int, list[int]] = {}
        for weight_bit in range(int(size.max()).bit_length() if dims else 0):
            used = np.flatnonzero((size >> weight_bit) & 1)
            first = used * self.bits + np.where(negative[used], len(self._plain), 0)
            for bit in range(self.bits):
                taken.setdefault(weight_bit + bit, []).append(first + bit)
        result: list[np.ndarray] = []
        carried: list[np.ndarray] = []
        place = 0
        while place <= max(taken, default=-1) or carried:
            parts = [self._maps[np.concatenate(taken[place])]] if place in taken else []
            stack = np.concatenate([*parts, *carried, np.zeros((0, len(self.valid)), np.uint64)])
            if not len(stack):
                stack = np.zeros((1, len(self.valid)), np.uint64)
            carried = []
            while len(stack) > 2:
                third = len(stack) // 3
                a, b, c = stack[:third], stack[third : 2 * third], stack[2 * third : 3 * third]
                half = a ^ b
                carried.append((a & b) | (half & c))
                half ^= c
                stack = np.concatenate([half, stack[3 * third :]])
            if len(stack) == 2:
                carried.append((stack[0] & stack[1])[None])
                stack = (stack[0] ^ stack[1])[None]
            result.append(stack[0])
            place += 1
        return result, constant

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows other than `own`, ties to smaller ids.

        From the highest slice down, rows with the bit set are surely in if they are k at most, else they alone stay
        candidates. What is left at the end has one score; its first rows by id fill up.
        """
        slices, constant = self.scores(query)
        candidates = self.valid.copy()
        first, last = np.searchsorted(self.ids, own, "left"), np.searchsorted(self.ids, own, "right")
        for row in range(first, last):
            candidates[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        sure, number = np.zeros_like(candidates), 0
        for bits in reversed(slices):
            above = candidates & bits
            count = int(np.bitwise_count(above).sum())
            if number + count > k:
                candidates = above
            else:
                sure |= above
                number += count
                candidates &= ~bits
        rows = np.flatnonzero(np.unpackbits(sure.view(np.uint8), bitorder="little"))
        if number < k:
            ties = np.flatnonzero(np.unpackbits(candidates.view(np.uint8), bitorder="little"))[: k - number]
            rows = np.concatenate([rows, ties])
        scores = np.full(len(rows), constant, dtype=np.int64)
        for place, bits in enumerate(slices):
            scores += ((bits[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64) << place
        return self.ids[rows], scores


def _unpacked(raw: bytes, rows: int, dims: int) -> np.ndarray:
    """rows x dims integers from what `quantised` packs."""
    kind = "<i8" if len(raw) == 8 * rows * dims else "<i4"
    return np.frombuffer(raw, dtype=kind).reshape(rows, dims).astype(np.int64)


def exact_top(ids: np.ndarray, values: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As `Slices.top`, without slices, for components of any size. Raises OverflowError for a score over 64 bits; one
    below them is given as the least number of 64 bits."""
    if np.abs(values.astype(float)).max() * np.abs(query.astype(float)).sum() < _INT64 / 2:
        scores = values @ query
    else:
        scores = values.astype(object) @ query.astype(object)
    best = sorted((-int(score), int(i)) for score, i in zip(scores, ids, strict=True) if i != own)[:k]
    if best and -best[0][0] >= 2**63:
        raise OverflowError(f"a score of vec_id {own} does not fit 64 bits")
    return np.array([i for _, i in best], np.int64), np.array([max(-score, _LEAST) for score, _ in best], np.int64)


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, dim and floor(scale * component) as little-endian 32-bit integers, or 64-bit ones where a component is
    large, of usable vectors. Components that do not fit 64 bits raise OverflowError, as in the SQL."""
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in by_dimension(batch.column(1)):
                values = np.floor(scale * matrix)
                if ((values >= _INT64) | (values < -_INT64)).any():
                    raise OverflowError("a component times the scale does not fit 64 bits")
                wide = np.abs(values).max(axis=1) >= _narrow(values.shape[1])
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column(0).take(pa.array(rows)),
                    "dim": pa.array([values.shape[1]] * len(rows), pa.int32()),
                    "values": pa.array([row.astype("<i8" if large else "<i4").tobytes() for row, large in zip(values, wide, strict=True)], pa.binary()),
                })

    return source.filter(F.col("vec_id").isNotNull() & is_usable(F.col("v"))).mapInArrow(make, "vec_id long, dim int, values binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE) -> DataFrame:
    """For each row that `is_query` (on vec_id) picks: rank, vec_id and score of the k best other rows.

    Rows are cut into blocks by a hash of vec_id and queries likewise; each pair of blocks is one group, with at most
    k rows for each query as its result, and the best of these are ranked. Vectors with large components are in blocks
    of their own; what meets them, or is one of them, is scored without slices. Vectors that are null, empty, or hold
    null or non-finite components, and those without an id, take no part. Only vectors of one length are compared.
    Components and scores among the k best that do not fit 64 bits are an error. Rows that repeat a vec_id are candidates each; a query's own id is none.
    Equal query rows count once. A query without candidates has no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    rows = scratch.write(quantised(vectors, scale), "quantised")
    queries = rows.filter(is_query).distinct()
    large = F.length("values") > 4 * F.col("dim")
    total, asked, wides = rows.agg(F.count("*"), F.count_if(is_query), F.count_if(large)).first()
    blocks, asks = max(1, -(-total // BLOCK_ROWS)), max(1, -(-asked // QUERY_ROWS))
    part = lambda number, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(number)).cast("int")

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        values = b"".join(frame["values"])
        ids = frame["vec_id"].to_numpy(np.int64)
        return pd.DataFrame({"dim": [int(frame["dim"].iloc[0])], "block": [int(frame["block"].iloc[0])], "ids": [ids.tobytes()], "rows": [values]})

    index = rows.withColumn("block", part(blocks, 1) + F.when(large, blocks).otherwise(0)).groupBy("dim", "block").applyInPandas(build, "dim int, block int, ids binary, rows binary")
    index = scratch.write(index, "index-blocks")
    each = index.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(asks - 1))))
    asked_rows = queries.withColumn("ask", part(asks, 2)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks * (2 if wides else 1) - 1))))
    keys = ["dim", "block", "ask"]

    def search(block: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "question": [], "vec_id": [], "score": []})]
        if len(block) and len(questions):
            ids = np.frombuffer(block["ids"].iloc[0], dtype=np.int64)
            dims = int(block["dim"].iloc[0])
            values = _unpacked(block["rows"].iloc[0], len(ids), dims)
            slices = Slices(ids, values) if int(block["block"].iloc[0]) < blocks else None
            for own, raw in zip(questions["vec_id"], questions["values"], strict=True):
                question = _unpacked(raw, 1, dims)[0]
                if slices is None or len(raw) > 4 * dims:
                    best, scores = exact_top(ids, values, question, int(own), k)
                else:
                    best, scores = slices.top(question, int(own), k)
                found.append(pd.DataFrame({"query_id": own, "question": [raw] * len(best), "vec_id": best, "score": scores}))
        return pd.concat(found).astype({"query_id": "int64", "vec_id": "int64", "score": "int64"})

    found = asked_rows.groupBy(*keys)
    found = each.groupBy(*keys).cogroup(found).applyInPandas(search, "query_id long, question binary, vec_id long, score long")
    best = Window.partitionBy("query_id", "question").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    score = F.when(F.col("score") == _LEAST, F.raise_error(F.lit("a score does not fit 64 bits"))).otherwise(F.col("score")).cast("long").alias("score")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", score)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


ORACLE_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""
