"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vendorium.llm.shipping import ship
from vendorium.llm.tokens import forget
from vendorium.llm.words import Words, buffers, chain, is_long, pieces

BITS = 20  # features are hashed to 2**BITS places; place 0 is the constant
SAMPLE_PER_CLASS = 4_000  # labelled documents of each class that are learned from at most
STEMS = (4, 5)  # first bytes of a word that stand for its inflected forms
FOLDS, HELD_OUT_FOLD = 5, 0

# Everything in ASCII but letters and digits separates words.
_TO_SPACE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


@dataclass(frozen=True)
class Rates:
    """FTRL settings: step size, its smoothing, L1 and L2 strength, and passes over the sample."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 5.0
    l2: float = 0.01
    passes: int = 3


@dataclass(frozen=True)
class Weights:
    """The weights that L1 left, by place; empty where nothing was learned."""

    places: np.ndarray
    values: np.ndarray

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << BITS, dtype=np.float32)
        table[self.places] = self.values
        return table


def feature_places(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """For each text the places of its words, word stems, pairs of words and pairs with one word between them,
    repeats included. Null and empty texts have none. Long texts are read in pieces that overlap by two words, and have
    each place once."""
    encoded = [(text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE) for text in texts]
    for first, last in buffers(encoded):
        if is_long(encoded[first]):
            yield np.unique(np.concatenate([np.unique(_places([piece])[0]) for piece in pieces(encoded[first], 2)]))
            continue
        yield from _places(encoded[first:last])


def _places(encoded: Sequence[bytes]) -> list[np.ndarray]:
    shift = np.uint64(64 - BITS)
    found = []
    if encoded:
        words = Words(encoded)
        single = words.hashes()
        kinds = [single, *(chain(words.hashes(size), np.uint64(size)) for size in STEMS)]
        pairs = [(chain(single[:-ahead], single[ahead:] + np.uint64(ahead)), ahead) for ahead in (1, 2) if len(single) > ahead]
        kinds = [(values >> shift).astype(np.int32) for values in kinds]
        pairs = [((values >> shift).astype(np.int32), ahead) for values, ahead in pairs]
        for start, end in zip(words.bounds[:-1], words.bounds[1:], strict=True):
            own = [values[start:end] for values in kinds] + [values[start : max(start, end - ahead)] for values, ahead in pairs]
            found.append(np.concatenate(own))
    return found


def learn(rows: Iterator[tuple[np.ndarray, int]], rates: Rates, shift: float = 0.0) -> Weights:
    """FTRL-proximal over (distinct places, label); `shift` is added to the constant at the end. Each place has a step size of its own, and
    its weight stays 0 until its summed gradients exceed L1."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(places: np.ndarray) -> np.ndarray:
        least = np.where(places == 0, 0.0, rates.l1)  # the constant is always learned
        pull = np.sign(z[places]) * least - z[places]
        value = pull / ((rates.beta + np.sqrt(n[places])) / rates.alpha + rates.l2)
        return np.where(np.abs(z[places]) <= least, 0.0, value)

    for places, label in rows:
        now = weights(places)
        chance = 1 / (1 + np.exp(-np.clip(now.sum(), -35, 35)))
        gradient = chance - label
        step = (np.sqrt(n[places] + gradient * gradient) - np.sqrt(n[places])) / rates.alpha
        z[places] += gradient - step * now
        n[places] += gradient * gradient
    used = np.flatnonzero(np.abs(z[1:]) > rates.l1) + 1
    constant = weights(np.zeros(1, dtype=np.int64)) + shift
    return Weights(np.append(0, used).astype(np.int32), np.append(constant, weights(used)).astype(np.float32))


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(folds))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, rates: Rates = Rates()) -> Weights:
    """Learn from a bounded sample of labelled documents outside the held-out fold.

    The sample is, for each class, the `per_class` documents whose ids have the smallest hashes. Classes are then
    mixed otherwise than in the table, which the constant makes up for (prior correction). A document labelled both ways counts as toxic; one with several texts counts with the smallest.
    Places are found on all executors; one task then goes over the sample, and the weights come back.
    """
    spark = docs.sparkSession
    ship(spark)
    key = F.col("doc_id").cast("long").alias("doc_id")
    known = labels.select(key, F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).withColumn("order", F.xxhash64("doc_id"))
    counts = dict(known.groupBy("toxic").count().collect())
    if not counts:
        return Weights(np.empty(0, np.int32), np.empty(0, np.float32))
    taken = [known.filter(F.col("toxic") == kind).orderBy("order", "doc_id").limit(per_class) for kind in (0, 1)]
    sample = taken[0].unionByName(taken[1])
    shift = math.log(max(1.0, counts.get(1, 0) / per_class)) - math.log(max(1.0, counts.get(0, 0) / per_class))
    texts = docs.select(key, F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")  # 2 * per_class rows at most
    texts = texts.groupBy("doc_id").agg(*[F.min(c).alias(c) for c in ("order", "toxic", "text")]).drop("doc_id")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slices = (batch.column("text").slice(at, 500).to_pylist() for at in range(0, batch.num_rows, 500))
            found = [np.unique(own).astype("<i4").tobytes() for texts in slices for own in feature_places(texts)]
            columns = [batch.column("order"), batch.column("toxic"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["order", "toxic", "places"])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[np.ndarray, int]]:
            constant = np.zeros(1, dtype=np.int32)
            for batch in batches:
                for raw, toxic in zip(batch.column("places").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                    own = np.frombuffer(raw, dtype="<i4")
                    yield np.concatenate([constant, own[own != 0]]), toxic

        learned = learn(rows(), rates, shift)
        yield pa.RecordBatch.from_pydict({"place": learned.places, "value": learned.values})

    found = texts.mapInArrow(places, "order long, toxic int, places binary")
    passes = F.explode(F.sequence(F.lit(1), F.lit(rates.passes))).alias("turn")
    ordered = found.select("*", passes).repartition(1).sortWithinPartitions("turn", "order")
    learned = ordered.mapInArrow(go, "place int, value float").toPandas()
    return Weights(learned["place"].to_numpy(np.int32), learned["value"].to_numpy(np.float32))


def scores(texts: Sequence[str | None], table: np.ndarray, learned: bool = True) -> np.ndarray:
    """The chance of label 1 of each text; a place counts once. 0 where nothing was learned."""
    sums = np.full(len(texts), float(table[0]))
    for row, own in enumerate(feature_places(texts)):
        hits = own[table[own] != 0]
        if len(hits):
            hits = np.unique(hits)
            sums[row] += float(table[hits[hits != 0]].sum())
    return 1 / (1 + np.exp(-np.clip(sums, -35, 35))) if learned else np.zeros(len(texts))


def score_column(weights: Weights) -> "callable":
    """A function from a text column to its score. The weights are sent once to each worker; 2**BITS bound them."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        table, learned = weights.dense(), len(weights.places) > 0
        for batch in batches:
            parts = [scores(batch.iloc[at : at + 500].tolist(), table, learned) for at in range(0, len(batch), 500)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score


def score_documents(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, held_out, score and predicted for every row. Null and empty texts get the score of no words; a null
    doc_id is in no fold and so is not held out."""
    ship(docs.sparkSession)
    score = score_column(weights)(F.col("text").cast("string"))
    held_out = (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out")
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, score.alias("score"))
    return scored.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
