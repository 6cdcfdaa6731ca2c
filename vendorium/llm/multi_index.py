"""Near-duplicate vectors by an inverted multi-index."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vendorium.llm.components import connected_components
from vendorium.llm.scratch import Scratch
from vendorium.llm.shipping import ship
from vendorium.llm.vectors import by_dimension, is_usable

THRESHOLD = 0.98
TARGET_RECALL = 0.99
SAMPLE_BYTES = 16 << 20  # codebooks are fitted on at most so many bytes of vectors
CELL_ROWS = 64  # rows that a cell of the grid should have about
MOST_CODES = 1024  # codes of one half at most, so the grid has up to a million cells for each label
CODE_ROWS = 16  # sample rows for each code at least
BLOCK_ROWS = 1024  # rows of a cell that are compared at once; larger cells are cut into blocks

_KEYS = ["label", "dim", "cell"]


def _halves(units: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Both halves, filled up with zeros to a common width."""
    filled = np.zeros((len(units), 2 * (-(-width // 2))))
    filled[:, : units.shape[1]] = units
    middle = filled.shape[1] // 2
    return filled[:, :middle], filled[:, middle:]


def _squared(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.maximum(0, (points**2).sum(1)[:, None] - 2 * points @ codes.T + (codes**2).sum(1))


def _nearest(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The nearest code of each point, some thousand points at a time."""
    return np.concatenate([_squared(points[at : at + 4096], codes).argmin(1) for at in range(0, len(points), 4096)])


def _codebook(points: np.ndarray, codes: int, seed: int) -> np.ndarray:
    """Some rounds of k-means."""
    random = np.random.default_rng(seed)
    centres = points[random.choice(len(points), min(codes, len(points)), replace=False)]
    for _ in range(8):
        nearest = _nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(1, counts)[:, None], centres)
    return np.unique(centres, axis=0)


@dataclass(frozen=True)
class MultiIndex:
    """Two codebooks, whose product is the grid, and how far a vector looks into it."""

    first: np.ndarray
    second: np.ndarray
    width: int
    reach: float

    def distances(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each vector's own cell, and for both halves how far at least the region of each code is.

        A code's region is where it is the nearest; the plane half-way between it and the nearest code is nearer than
        any point of it.
        """
        found = []
        for points, codes in zip(_halves(units, self.width), (self.first, self.second), strict=True):
            squared = _squared(points, codes)
            own = squared.argmin(1)
            apart = np.sqrt(_squared(codes, codes))[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                gap = (squared - squared[np.arange(len(own)), own][:, None]) / (2 * apart)
            gap[np.arange(len(own)), own] = 0
            found.append((own, np.nan_to_num(gap, nan=0.0)))
        (a, first), (b, second) = found
        return a * len(self.second) + b, first, second

    def visits(self, units: np.ndarray) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
        """Own cells, and (rows, cells) by multi-sequence traversal: both halves' codes in order of distance, pair
        after pair, until no vector reaches the next."""
        own, first, second = self.distances(units)
        orders = [np.argsort(gaps, axis=1, kind="stable") for gaps in (first, second)]
        sorted_gaps = [np.take_along_axis(gaps, order, 1) ** 2 for gaps, order in zip((first, second), orders, strict=True)]

        def traverse() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            limit = self.reach**2
            for i in range(first.shape[1]):
                rows = np.flatnonzero(sorted_gaps[0][:, i] <= limit)
                if not len(rows):
                    return
                for j in range(second.shape[1]):
                    rows = rows[sorted_gaps[0][rows, i] + sorted_gaps[1][rows, j] <= limit]
                    if not len(rows):
                        break
                    yield rows, orders[0][rows, i] * len(self.second) + orders[1][rows, j]

        return own, traverse()


def fit(sample: np.ndarray, total: int, threshold: float, recall: float) -> MultiIndex:
    """Codebooks for labels of about `total` vectors from a sample of unit vectors, and the reach that finds `recall` of the pairs
    at the threshold itself, measured on sample vectors turned by that angle in a random direction. Closer pairs are
    found more often. The reach never exceeds the distance at the threshold, which finds all."""
    width = sample.shape[1]
    codes = int(max(2, min(MOST_CODES, len(sample) / CODE_ROWS, math.sqrt(total / CELL_ROWS))))
    first, second = _halves(sample, width)
    index = MultiIndex(_codebook(first, codes, 1), _codebook(second, codes, 2), width, 0.0)
    random = np.random.default_rng(3)
    tested = sample[random.choice(len(sample), min(4000, len(sample)), replace=False)]
    aside = random.standard_normal(tested.shape)
    aside -= (aside * tested).sum(1)[:, None] * tested
    norms = np.linalg.norm(aside, axis=1)
    turned = threshold * tested + math.sqrt(1 - threshold**2) * aside / np.where(norms > 0, norms, 1)[:, None]
    own, gaps_first, gaps_second = index.distances(tested)
    other = index.distances(turned)[0]
    rows = np.arange(len(tested))
    needed = np.sqrt(gaps_first[rows, other // len(index.second)] ** 2 + gaps_second[rows, other % len(index.second)] ** 2)
    reach = min(math.sqrt(2 - 2 * threshold), float(np.quantile(needed, recall, method="higher")) + 1e-9)
    return MultiIndex(index.first, index.second, width, reach)


def _unit_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, cls, unit of vectors that can link; cls is a digest of label, dimension and direction."""
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    usable = F.col("label").isNotNull() & is_usable(F.col("v")) & F.exists("v", lambda x: x != 0)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            for rows, matrix in by_dimension(batch.column(2)):
                matrix = matrix / np.abs(matrix).max(axis=1)[:, None]
                units = matrix / np.linalg.norm(matrix, axis=1)[:, None] + 0.0  # no negative zeros
                raw = [unit.tobytes() for unit in units]
                cls = [hashlib.blake2b(one + b"/" + labels[row].encode(), digest_size=16, salt=units.shape[1].to_bytes(8)).digest() for one, row in zip(raw, rows, strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "vec_id": batch.column(0).take(pa.array(rows)),
                    "label": pa.array([labels[row] for row in rows], pa.string()),
                    "dim": pa.array([units.shape[1]] * len(rows), pa.int32()),
                    "cls": pa.array(cls, pa.binary()),
                    "unit": pa.array(raw, pa.binary()),
                })

    return source.filter(usable).mapInArrow(make, "vec_id long, label string, dim int, cls binary, unit binary")


def _compare(frame: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links within one pair of blocks: for each class the copies it links with, and one link to the smallest class
    of its component here, so that the result has a row for each class at most."""
    units = np.stack([np.frombuffer(unit) for unit in frame["unit"]])
    left = np.flatnonzero((frame["block"] == frame["low_block"]).to_numpy())
    right = np.flatnonzero((frame["block"] == frame["high_block"]).to_numpy())
    resident, copies = frame["resident"].to_numpy(bool), frame["copies"].to_numpy(np.int64)
    linked = units[left] @ units[right].T >= threshold
    linked &= resident[left][:, None] | resident[right]
    if frame["low_block"].iloc[0] == frame["high_block"].iloc[0]:
        linked &= left[:, None] < right
    x, y = np.nonzero(linked)
    x, y = left[x], right[y]
    counts = np.bincount(x, copies[y], len(frame)) + np.bincount(y, copies[x], len(frame))
    names = frame["cls"].to_numpy()
    root = np.arange(len(frame))
    root[np.argsort(names, kind="stable")] = np.arange(len(frame))  # places in the order of the classes
    place, smallest = root.copy(), None
    while smallest is None or (smallest != root).any():
        smallest = root.copy()
        np.minimum.at(root, x, smallest[y])
        np.minimum.at(root, y, smallest[x])
    by_place = np.empty(len(frame), dtype=object)
    by_place[place] = names
    rows = np.flatnonzero(counts)
    return pd.DataFrame({"high": names[rows], "low": by_place[root[rows]], "links": counts[rows].astype(np.int64)})


def link_components(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors (vec_id, label, embedding).

    Rows with equal label, dimension and direction are one class, found by a digest, and classes are compared:

    1. Two codebooks for the halves of the vectors are fitted on a bounded sample; their product is the grid.
    2. Every class lies in its cell and visits those of the cells after it that its reach touches, nearest first.
    3. In each cell, residents are compared with residents and visitors, in double precision, in blocks of bounded
       size. Numbers of links and one link for each class leave a block, not its pairs.

    Vectors with a null label or that are null, empty, zero, or have null or non-finite components have no links and
    are their own component. Repeated rows are copies and link. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    units = scratch.write(_unit_rows(vectors), "units")
    classes = units.groupBy("label", "dim", "cls").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.min("unit").alias("unit"))
    classes = scratch.write(classes, "classes")
    # Cells are those of one label, so the grid goes by the size of the label that a vector is in on average.
    labels = classes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    total, width = labels.agg(F.coalesce(F.sum(F.col("n").cast("double") ** 2) / F.sum("n"), F.lit(0.0)), F.coalesce(F.max("dim"), F.lit(1))).first()
    rows = max(2, SAMPLE_BYTES // (8 * width))
    drawn = classes.select("unit").orderBy(F.xxhash64("cls")).limit(rows).toPandas()["unit"]
    sample = np.zeros((max(1, len(drawn)), width))
    for row, raw in enumerate(drawn):
        sample[row, : len(raw) // 8] = np.frombuffer(raw)
    index = fit(sample, total, threshold, recall)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                matrix = np.zeros((batch.num_rows, index.width))
                for row, raw in enumerate(batch.column("unit").to_pylist()):
                    matrix[row, : len(raw) // 8] = np.frombuffer(raw)
                own, visits = index.visits(matrix)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(np.ones(len(own), bool))], names=[*batch.schema.names, "cell", "resident"])
                for reached, cells in visits:
                    later = cells > own[reached]
                    if later.any():
                        part = batch.take(pa.array(reached[later]))
                        yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells[later]), pa.array(np.zeros(part.num_rows, bool))], names=[*part.schema.names, "cell", "resident"])

    schema = "label string, dim int, cls binary, copies long, unit binary, cell long, resident boolean"
    placed = classes.select("label", "dim", "cls", "copies", "unit").mapInArrow(assign, schema)
    placed = scratch.write(placed, "placed")
    cells = placed.groupBy(*_KEYS).agg(F.count("*").alias("rows"), F.count_if("resident").alias("residents"))
    cells = cells.filter("residents > 0 and rows > 1").select(*_KEYS, F.ceil(F.col("rows") / BLOCK_ROWS).cast("int").alias("blocks"))
    blocked = placed.join(cells, _KEYS).withColumn("block", F.pmod(F.xxhash64("cls", F.lit(7)), "blocks").cast("int"))
    # Each block meets each block of its cell, itself included, once.
    blocked = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocked = blocked.select("*", F.least("block", "other").alias("low_block"), F.greatest("block", "other").alias("high_block"))
    schema = "high binary, low binary, links long"
    found = blocked.groupBy(*_KEYS, "low_block", "high_block").applyInPandas(lambda frame: _compare(frame, threshold), schema)
    found = scratch.write(found, "found")
    counts = found.groupBy(F.col("high").alias("cls")).agg(F.sum("links").alias("links"))
    joined = scratch.write(connected_components(found.select("high", "low"), scratch), "components")

    named = classes.select("cls", "least", "copies").join(joined.withColumnRenamed("node", "cls"), "cls", "left").join(counts, "cls", "left")
    named = named.withColumn("component", F.coalesce("component", "cls"))
    labels = named.groupBy("component").agg(F.min("least").alias("component_id"))
    links = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    results = named.join(labels, "component").select("cls", links, "component_id")
    linked = units.select("vec_id", "cls").join(results, "cls").select("vec_id", "n_links", "component_id")
    usable = F.col("label").isNotNull() & is_usable(F.col("embedding")) & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    alone = vectors.filter(~usable).select(F.col("vec_id").cast("long").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked.unionByName(alone).select("*", kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
