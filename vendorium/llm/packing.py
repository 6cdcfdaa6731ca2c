"""Best-fit decreasing packing of token sequences."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vendorium.llm.scratch import Scratch, fresh_name
from vendorium.llm.shipping import ship
from vendorium.llm.tokens import default_vocabulary, encoder, read_vocabulary

CAPACITY = 4096
END_ID = 1
_RANK_BITS = 40  # places of items of one length; 2**40 items of one length are allowed

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

Batches = Iterator[pa.RecordBatch]


class CapacityTree:
    """A segment tree over remaining capacities 0..capacity: which of them an open bin has."""

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._any = bytearray(2 * self._leaves)

    def set(self, remaining: int, present: bool) -> None:
        node = self._leaves + remaining
        self._any[node] = present
        while node > 1:
            node >>= 1
            self._any[node] = self._any[2 * node] | self._any[2 * node + 1]

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least `length` that an open bin has."""
        node = self._leaves + length
        if self._any[node]:
            return length
        while node > 1:
            if not node & 1 and self._any[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if self._any[2 * node] else 2 * node + 1
                return node - self._leaves
            node >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where best-fit decreasing puts `counts[length]` items of each length.

    Items of one length are alike, so they are placed in runs: the tightest bins that have room take as many as fit
    before the next, exactly as one item after the other would go. Returns rows (length, first item, items for each
    bin, first bin, place in the bin), sorted; item i of a run is in bin `first bin + i // items`. The number of rows
    depends on the lengths that occur and not on how many items there are.
    """
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> (first bin, bins)
    bins = 0
    runs: list[tuple[int, int, int, int, int]] = []

    def keep(remaining: int, first: int, number: int) -> None:
        if number and remaining:
            if remaining not in open_bins:
                open_bins[remaining] = []
                tree.set(remaining, True)
            open_bins[remaining].append((first, number))

    for length in sorted(counts, reverse=True):
        item, left = 0, counts[length]
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, first, number = capacity, bins, -(-left // (capacity // length))
                bins += number
            else:
                first, number = open_bins[remaining].pop()
                if not open_bins[remaining]:
                    del open_bins[remaining]
                    tree.set(remaining, False)
            each = remaining // length
            placed = min(left, each * number)
            full, rest = divmod(placed, each)
            runs.append((length, item, each, first, capacity - remaining))
            keep(remaining - each * length, first, full)
            if rest:
                keep(remaining - rest * length, first + full, 1)
            untouched = full + (rest > 0)
            keep(remaining, first + untouched, number - untouched)
            item, left = item + placed, left - placed
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _piece_schema(ids: bool) -> str:
    return PIECE_SCHEMA + (", ids binary" if ids else "")


def _cutter(vocabulary: str, end_id: int, capacity: int, ids: bool, known: int | None) -> Callable[[Batches], Batches]:
    """The function that makes pieces of a task's texts."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Batches) -> Batches:
        encode = encoder(vocabulary, known).encode_many
        names = ("doc_id", "piece", "start", "length", "ids_crc32") + ("ids",) * ids
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), encode(text.as_py() for text in batch.column(1)), strict=True):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part if ids else None))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [pa.array(columns[place], kinds[place]) for place in range(len(names))]
            yield pa.RecordBatch.from_arrays(arrays, names=list(names))

    return cut


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, ids: bool = False, known: int | None = None) -> DataFrame:
    """Each text's token ids and the end id, cut into pieces of at most `capacity` ids.

    Null and empty texts have the end id alone. With `ids`, a last column holds the ids of the piece as
    little-endian unsigned 32-bit integers. A worker remembers the ids of `known` words, twice at most; results do not
    depend on it.
    """
    ship(docs.sparkSession)
    return _texts(docs).mapInArrow(_cutter(vocabulary, end_id, capacity, ids, known), _piece_schema(ids))


def best_fit_pack(items: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """Add `sequence_id` and `offset`: best-fit decreasing over all items.

    Items are numbered within their length: each task counts its own, and totals of tasks before it are added. Only
    the number of items of each length, at most `capacity` numbers, goes to the driver, which plans all bins there.
    Lengths that are null, below 1 or above the capacity get null in both columns. Columns of `items` with the names
    of the new ones are replaced. Equal lengths are interchangeable; which of them shares a sequence with which
    other follows the order of the rows in the files.
    """
    kept = [name for name in items.columns if name.lower() not in ("sequence_id", "offset")]
    source = items.select(*kept, F.col(length).cast("long").alias(fresh_name("_size", kept)))
    return _packed(source, source.schema, lambda batches: batches, capacity)


def _packed(source: DataFrame, schema: StructType, make: Callable[[Batches], Batches], capacity: int) -> DataFrame:
    """Pack the items that `make` makes of a task's rows of `source`: columns of `schema`, the last one the length.

    Items are made and numbered in one step, so that a task has one Python worker: each stands beside the others of its
    executor, and Spark keeps it for the work that follows.
    """
    spark = source.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    *kept, size = schema.names
    part, rank, base = (fresh_name(name, schema.names) for name in ("_part", "_rank", "_base"))
    numbered_schema = StructType([*schema.fields, StructField(part, LongType()), StructField(rank, LongType())])

    def number(batches: Batches) -> Batches:
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in make(batches):
            sizes = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            sizes = np.nan_to_num(sizes.astype(np.float64), nan=0).astype(np.int64)
            sizes[(sizes < 1) | (sizes > capacity)] = 0
            order = np.argsort(sizes, kind="stable")
            ordered = sizes[order]
            firsts = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, bool)
            starts = np.flatnonzero(firsts)
            run = np.diff(np.append(starts, len(ordered)))
            places = np.empty(len(sizes), dtype=np.int64)
            places[order] = np.arange(len(sizes)) - np.repeat(starts, run) + seen[ordered]
            seen[ordered[starts]] += run
            arrays = [*batch.columns, pa.array(np.full(len(sizes), task, dtype=np.int64)), pa.array(places)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, part, rank])

    numbered = scratch.write(source.mapInArrow(number, numbered_schema), "packing-items")
    counts = scratch.write(numbered.groupBy(part, size).agg(F.count("*").alias(base)), "packing-counts")
    fits = F.col(size).between(1, capacity)
    totals = {row[0]: row[1] for row in counts.filter(fits).groupBy(size).agg(F.sum(base)).collect()}
    plan = best_fit_plan(totals, capacity)
    earlier = Window.partitionBy(size).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.filter(fits).select(part, size, F.coalesce(F.sum(base).over(earlier), F.lit(0)).alias(base))
    keys = (plan[:, 0] << _RANK_BITS) + plan[:, 1]
    placed_schema = StructType([*schema.fields[:-1], StructField("sequence_id", LongType()), StructField("offset", LongType())])

    def place(batches: Batches) -> Batches:
        for batch in batches:
            lengths = batch.column(len(kept))
            missing = pa.array(batch.column(len(kept) + 1)).is_null().to_numpy(zero_copy_only=False)
            sizes = np.nan_to_num(lengths.to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
            ranks = np.nan_to_num(batch.column(len(kept) + 1).to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
            if len(plan):
                run = np.maximum(np.searchsorted(keys, (sizes << _RANK_BITS) + ranks, side="right") - 1, 0)
                item = ranks - plan[run, 1]
                sequence, offset = plan[run, 3] + item // plan[run, 2], plan[run, 4] + item % plan[run, 2] * sizes
            else:
                sequence = offset = np.zeros(len(sizes), dtype=np.int64)
            arrays = [*batch.columns[: len(kept)], pa.array(sequence, mask=missing), pa.array(offset, mask=missing)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[: len(kept)], "sequence_id", "offset"])

    ranked = numbered.join(before, [part, size], "left").select(*kept, size, (F.col(base) + F.col(rank)).alias(rank))
    return ranked.mapInArrow(place, placed_schema)


def assemble(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence from pieces with their ids: at most `capacity` ids a group."""
    pieces = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(pieces, F.lit(b""), lambda whole, piece: F.concat(whole, piece["ids"]))
    return packed.filter("sequence_id is not null").groupBy("sequence_id").agg(joined.alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = CAPACITY, ids: bool = False, known: int | None = None) -> DataFrame:
    """Encode, cut and pack whole documents: a row for each piece. An empty table gives no rows."""
    cut = _cutter(vocabulary, end_id, capacity, ids, known)

    def sized(batches: Batches) -> Batches:
        for batch in cut(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, batch.column("length")], names=[*batch.schema.names, "_size"])

    return _packed(_texts(docs), StructType.fromDDL(_piece_schema(ids) + ", _size long"), sized, capacity)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), read_vocabulary(default_vocabulary()))
