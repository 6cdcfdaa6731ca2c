"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vendorium.llm.shipping import ship
from vendorium.llm.tokens import forget
from vendorium.llm.words import buffers, is_long

ORDER = 3  # longest context, in bytes
SAMPLE_PER_LANGUAGE = 2_000  # documents of each language that statistics are taken from, about
SAMPLE_BYTES = 24 << 20  # text bytes of all languages together, about
MOST_LANGUAGES = 4_096
FOLDS, HELD_OUT_FOLD = 4, 2
UNKNOWN = "und"
RAW_BITS = 8.0  # bits a byte takes without a model

_START = b"\n" * ORDER  # what stands before a text
_SLOTS = 18  # binary logarithm of the places of a worker's table of windows, for up to 32 languages
_PIECE = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")


def windows(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of the texts the byte with the `ORDER` bytes before it as one number, and each text's length."""
    buffer = np.frombuffer(b"".join(_START + text for text in texts), dtype=np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    whole = buffer[ORDER:].copy()
    for back in range(1, ORDER + 1):
        whole |= buffer[ORDER - back : len(buffer) - back] << np.uint32(8 * back)
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
    keep = np.zeros(len(whole) + ORDER + 1, dtype=np.int8)
    np.add.at(keep, starts, 1)
    np.add.at(keep, starts + lengths, -1)
    return whole[np.cumsum(keep[: len(whole)]).astype(bool)], lengths


def long_windows(text: bytes) -> Iterator[np.ndarray]:
    """The windows of one text, some at a time."""
    for at in range(0, len(text), _PIECE):
        before = text[max(0, at - ORDER) : at]
        yield windows([before + text[at : at + _PIECE]])[0][len(before) :]


def normal(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class ContextTree:
    """One language: for each context length the contexts with their escape's cost, and the bytes seen after them.

    Costs are in bits. A context seen n times with q different bytes after it gives a byte seen c times
    c / (n + q) and keeps q / (n + q) for the escape to the context one byte shorter (escape method C, without
    exclusion). Below the empty context all 256 bytes are alike.
    """

    contexts: tuple[np.ndarray, ...]
    escapes: tuple[np.ndarray, ...]
    symbols: tuple[np.ndarray, ...]
    costs: tuple[np.ndarray, ...]

    @staticmethod
    def of(windows: np.ndarray, counts: np.ndarray) -> ContextTree:
        parts: list[list[np.ndarray]] = [[], [], [], []]
        for order in range(ORDER + 1):
            symbols, place = np.unique(windows & np.uint32((1 << (8 * order + 8)) - 1), return_inverse=True)
            seen = np.bincount(place, weights=counts, minlength=len(symbols))
            contexts, place, different = np.unique(symbols >> np.uint32(8), return_inverse=True, return_counts=True)
            total = np.bincount(place, weights=seen, minlength=len(contexts)) + different
            for part, values in zip(parts, (contexts, np.log2(total / different), symbols, np.log2(total[place] / seen)), strict=True):
                part.append(values)
        return ContextTree(*map(tuple, parts))

    def cost(self, windows: np.ndarray) -> np.ndarray:
        """The exact code length of each window's last byte after its other bytes."""
        bits, open_ = np.zeros(len(windows)), np.ones(len(windows), dtype=bool)
        for order in range(ORDER, -1, -1):
            symbol = windows & np.uint32((1 << (8 * order + 8)) - 1)
            context = symbol >> np.uint32(8)
            at = np.minimum(np.searchsorted(self.contexts[order], context), len(self.contexts[order]) - 1)
            known = open_ & (self.contexts[order][at] == context)
            own = np.minimum(np.searchsorted(self.symbols[order], symbol), len(self.symbols[order]) - 1)
            found = known & (self.symbols[order][own] == symbol)
            bits[found] += self.costs[order][own[found]]
            escaped = known & ~found
            bits[escaped] += self.escapes[order][at[escaped]]
            open_ &= ~found
        return bits + np.where(open_, RAW_BITS, 0.0)


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    trees: tuple[ContextTree, ...]


class Scorer:
    """Code lengths of texts under all languages. Costs of windows met before are kept in a table of fixed size."""

    def __init__(self, languages: Languages):
        self._languages = languages
        self._slots = max(8, _SLOTS - max(0, (len(languages.names) - 1).bit_length() - 5))  # fewer places for more languages
        self._keys = np.zeros(1 << self._slots, dtype=np.uint32)
        self._filled = np.zeros(1 << self._slots, dtype=bool)
        self._costs = np.zeros((1 << self._slots, len(languages.names)), dtype=np.float32)

    def _window_costs(self, found: np.ndarray) -> np.ndarray:
        slots = (found * np.uint32(2654435761)) >> np.uint32(32 - self._slots)
        missing = np.flatnonzero((self._keys[slots] != found) | ~self._filled[slots])
        costs = self._costs[slots]
        if len(missing):
            new, place = np.unique(found[missing], return_inverse=True)
            own = np.stack([tree.cost(new) for tree in self._languages.trees], axis=1).astype(np.float32)
            costs[missing] = own[place]
            slots = (new * np.uint32(2654435761)) >> np.uint32(32 - self._slots)
            slots, first = np.unique(slots, return_index=True)
            self._keys[slots], self._filled[slots], self._costs[slots] = new[first], True, own[first]
        return costs

    def bits(self, texts: Sequence[bytes]) -> np.ndarray:
        """Total bits of each text under each language. Long texts are read in pieces."""
        totals = np.zeros((len(texts), len(self._languages.names)))
        for first, last in buffers(texts):
            if is_long(texts[first]):
                totals[first] = sum(self._window_costs(found).sum(axis=0, dtype=np.float64) for found in long_windows(texts[first]))
                continue
            found, lengths = windows(texts[first:last])
            rows = np.flatnonzero(lengths)
            if len(rows):
                starts = np.concatenate([[0], np.cumsum(lengths[rows])[:-1]])
                costs = self._window_costs(found)
                for language in range(costs.shape[1]):
                    totals[first + rows, language] = np.add.reduceat(costs[:, language].astype(np.float64), starts)
        return totals

    def predict(self, texts: Sequence[str | None]) -> pd.DataFrame:
        names = np.array(self._languages.names, dtype=object)
        raw = [normal(text) for text in texts]
        lettered = np.fromiter((bool(_LETTER.search(text or "")) for text in texts), dtype=bool, count=len(texts))
        if not len(names) or not len(texts):
            return pd.DataFrame({"lang_pred": [UNKNOWN] * len(texts), "score": 0.0, "bits_per_byte": 0.0})
        bits = self.bits(raw)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(texts)), best]
        chance = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
        per_byte = least / np.maximum(1, np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        known = lambda values, other: np.where(lettered, values, other)
        return pd.DataFrame({"lang_pred": known(names[best], UNKNOWN), "score": known(chance, 0.0), "bits_per_byte": per_byte})


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(folds))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Languages:
    """Statistics of a bounded sample of whole texts with a language, outside the held-out fold.

    A document is in the sample if the hash of its id and text is below the share that leaves about `per_language`
    of its language, or its part of `SAMPLE_BYTES` if that is less: many languages or long texts make shares smaller, so
    what the driver gets, one number for each language and window of the sample, does not grow with either. Of more than
    `MOST_LANGUAGES` languages those with the most documents are learned. Windows are counted on the executors.
    Languages without a letter in their sample still count. No language at all gives an empty model.
    """
    ship(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != HELD_OUT_FOLD))
    counts = known.groupBy("lang").agg(F.count("*").alias("docs"), F.sum(F.octet_length("text")).alias("bytes"))
    most = counts.orderBy(F.desc("docs"), "lang").limit(MOST_LANGUAGES).collect()
    if not most:
        return Languages((), ())
    names = sorted(row.lang for row in most)
    place = {name: at for at, name in enumerate(names)}
    shares = [min(1.0, per_language / row.docs, SAMPLE_BYTES / len(most) / max(1, row.bytes)) for row in most]
    # As an Arrow table: Python rows would start workers of another kind beside those that count.
    shares = pa.table({"place": pa.array([place[row.lang] for row in most], pa.int32()), "lang": [row.lang for row in most], "share": shares})
    shares = docs.sparkSession.createDataFrame(shares)  # MOST_LANGUAGES rows at most
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 52)) / F.lit(float(1 << 52))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pd.DataFrame({"place": batch.column(0).to_pylist(), "text": batch.column(1).to_pylist()})
            for place, own in rows.groupby("place"):
                texts = [normal(text) for text in own["text"]]
                parts = (part for first, last in buffers(texts) for part in (long_windows(texts[first]) if is_long(texts[first]) else [windows(texts[first:last])[0]]))
                for part in parts:
                    found, number = np.unique(part, return_counts=True)
                    yield pa.RecordBatch.from_pydict({"place": pa.array([place] * len(found), pa.int32()), "window": found.astype(np.int64), "seen": number.astype(np.int64)})

    sample = known.join(F.broadcast(shares), "lang").filter(drawn < F.col("share")).select("place", "text").mapInArrow(count, "place int, window long, seen long")
    seen = sample.groupBy("place", "window").agg(F.sum("seen").alias("seen")).toPandas().sort_values(["place", "window"])
    starts = np.searchsorted(seen["place"].to_numpy(), np.arange(len(names) + 1))
    windows_, number = seen["window"].to_numpy(np.uint32), seen["seen"].to_numpy(np.float64)
    learned = [at for at in range(len(names)) if starts[at] < starts[at + 1]]
    trees = (ContextTree.of(windows_[starts[at] : starts[at + 1]], number[starts[at] : starts[at + 1]]) for at in learned)
    return Languages(tuple(names[at] for at in learned), tuple(trees))


def predict_column(languages: Languages) -> Callable[[Column], Column]:
    """A function from a text column to (lang_pred, score, bits_per_byte)."""

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        scorer = Scorer(languages)
        for batch in batches:
            parts = [scorer.predict(batch.iloc[at : at + 500].tolist()) for at in range(0, max(1, len(batch)), 500)]
            yield pd.concat(parts, ignore_index=True)

    return predict


def predict_documents(docs: DataFrame, languages: Languages) -> DataFrame:
    """doc_id, held_out, lang_pred, score and bits_per_byte for every row.

    The language is the one that codes the whole text in the fewest bits, the first by name if equal; the score is
    its chance if all languages are alike beforehand. Null texts and texts without a letter are `und` with score 0.
    """
    ship(docs.sparkSession)
    found = predict_column(languages)(F.col("text").cast("string")).alias("found")
    held_out = (fold(F.col("doc_id")) == HELD_OUT_FOLD).alias("held_out")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, found).select("doc_id", "held_out", "found.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict_documents(docs, train(docs))
