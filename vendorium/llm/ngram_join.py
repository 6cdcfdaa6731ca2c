"""Jaccard self-join of word n-gram sets by vertical partitioning of a global n-gram order."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vendorium.llm.components import connected_components
from vendorium.llm.scratch import Scratch, fresh_name
from vendorium.llm.shipping import ship
from vendorium.llm.tokens import forget
from vendorium.llm.words import mix, shingle_sets

WORDS, PERCENT = 4, 85
FRAGMENTS = 8
_TRIES = 8
_BUCKET_BITS = 18  # n-grams are counted in 2**18 buckets of their hash
_LOW_BITS = np.uint64(64 - _BUCKET_BITS)
_LOW_MASK = (np.uint64(1) << _LOW_BITS) - np.uint64(1)
_FILTER_BITS = 22  # classes that take part in a check are marked in 2**22 bits


def digest(values: bytes, seed: int) -> int:
    """The number of a set: 64 bits of a digest."""
    return int.from_bytes(hashlib.blake2b(values, digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "big", signed=True)


@dataclass(frozen=True)
class Sets:
    """How texts become numbered sets: words a shingle, and the digest with its seed."""

    words: int
    digest: Callable[[bytes, int], int] = digest
    seed: int = 0

    def number(self, values: np.ndarray) -> int:
        return self.digest(values.tobytes(), self.seed)


def _classes(batch: pa.RecordBatch, sets: Sets) -> Iterator[tuple[int, np.ndarray]]:
    """For each text of the batch's `text` column the number of its set, and the set as sorted hashes."""
    for at in range(0, batch.num_rows, 500):
        for values in shingle_sets(batch.column("text").slice(at, 500).to_pylist(), sets.words):
            yield sets.number(values), values


def _members(docs: DataFrame, sets: Sets, carry: Sequence[str]) -> DataFrame:
    """doc_id, what is carried along, set size n, the number cls of the set, and another 64 bits to hold it against."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [(len(values), cls, _check(values)) for cls, values in _classes(batch, sets)]
            arrays = [pa.array([row[at] for row in found], kind) for at, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            names = ["doc_id", *batch.schema.names[2:], "n", "cls", "other"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], *arrays], names=names)

    return source.mapInArrow(make, f"doc_id long, {kinds + ', ' if kinds else ''}n int, cls long, other long")


def _check(values: np.ndarray) -> int:
    """64 bits of a set that do not depend on its digest."""
    return int(np.add.reduce(mix(values)).view(np.int64)) if len(values) else 0


def _each_class(batches: Iterator[pa.RecordBatch], sets: Sets) -> Iterator[tuple[int, np.ndarray]]:
    """The classes of a task's texts, each once, without the empty set: copies go before anything is shuffled."""
    forget()
    seen: set[int] = set()
    for batch in batches:
        for cls, grams in _classes(batch, sets):
            if len(grams) and cls not in seen:
                seen.add(cls)
                yield cls, grams


class GramOrder:
    """The global order: rarer buckets first, then by hash. A hash and its place in the order are one to one."""

    def __init__(self, counts: np.ndarray, fragments: int):
        order = np.argsort(counts, kind="stable")
        self.rank = np.empty(len(counts), dtype=np.uint64)
        self.rank[order] = np.arange(len(counts), dtype=np.uint64)
        shares = np.cumsum(counts[order]) * fragments / max(1, counts.sum())
        cuts = np.searchsorted(shares, np.arange(1, fragments))
        self.pivots = cuts.astype(np.uint64) << _LOW_BITS

    def places(self, grams: np.ndarray) -> np.ndarray:
        """The sorted places of a set's n-grams."""
        bucket = (grams >> _LOW_BITS).astype(np.int64)
        return np.sort((self.rank[bucket] << _LOW_BITS) | (grams & _LOW_MASK))


def _gram_order(texts: DataFrame, sets: Sets, fragments: int) -> GramOrder:
    """Count all n-grams in buckets; the driver gets one number for each of the 2**18 buckets, whatever the input."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _BUCKET_BITS, dtype=np.int64)
        for _, grams in _each_class(batches, sets):
            buckets, seen = np.unique((grams >> _LOW_BITS).astype(np.int64), return_counts=True)
            counts[buckets] += seen
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": used.astype(np.int32), "seen": counts[used]})

    rows = texts.mapInArrow(count, "bucket int, seen long").groupBy("bucket").agg(F.sum("seen").alias("seen")).toPandas()
    counts = np.zeros(1 << _BUCKET_BITS, dtype=np.int64)
    counts[rows["bucket"].to_numpy(np.int64)] = rows["seen"].to_numpy(np.int64)
    return GramOrder(counts, fragments)


def _prefixes(texts: DataFrame, sets: Sets, order: GramOrder, percent: int) -> DataFrame:
    """The rarest n-grams of each class, so many that two similar sets must share one: (gram, cls, n, place)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cls, grams in _each_class(batches, sets):
            size = len(grams)
            prefix = order.places(grams)[: size - -(-percent * size // 100) + 1]
            columns = [
                pa.array(prefix.view(np.int64)),
                pa.array(np.full(len(prefix), cls, np.int64)),
                pa.array(np.full(len(prefix), size, np.int32)),
                pa.array(np.arange(len(prefix), dtype=np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["gram", "cls", "n", "place"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in make(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 10_000:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, rows = [], 0
        if rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    return texts.mapInArrow(joined, "gram long, cls long, n int, place int")


def _left_out(n: Column, percent: int) -> Column:
    """How many n-grams of a class with n are not among those that it puts forward."""
    return F.floor((percent * n.cast("long") + 99) / 100) - 1


def _can_link(n: Column, place: Column, other_n: Column, other_place: Column, percent: int) -> Column:
    """Whether sets that share the n-gram at these places can be similar.

    The first n-gram that two sets share bounds their intersection by what is left of either set from there on, so
    every similar pair passes at least at that one.
    """
    sizes = (100 * F.least(n, other_n) >= percent * F.greatest(n, other_n))
    left = F.least(n - place, other_n - other_place).cast("long")
    return sizes & (left * (100 + percent) >= percent * (n.cast("long") + other_n))


def _pairs(joined: DataFrame) -> DataFrame:
    """(low, high) with their sizes, each pair once."""
    first = F.col("cls") < F.col("other")
    low, high = F.when(first, F.col("cls")).otherwise(F.col("other")), F.when(first, F.col("other")).otherwise(F.col("cls"))
    low_n, high_n = F.when(first, F.col("n")).otherwise(F.col("other_n")), F.when(first, F.col("other_n")).otherwise(F.col("n"))
    return joined.select(low.alias("low"), high.alias("high"), low_n.alias("low_n"), high_n.alias("high_n")).distinct()


def _sharing_enough(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs that share enough of the n-grams that both put forward; `rows` has (cls, gram) for all of
    these. The others that two sets share come after the end of one prefix, so at most what that one left out.
    """
    grams = rows.groupBy("cls").agg(F.collect_list("gram").alias("grams"))
    low = grams.select(F.col("cls").alias("low"), F.col("grams").alias("low_grams"))
    high = grams.select(F.col("cls").alias("high"), F.col("grams").alias("high_grams"))
    common = F.size(F.array_intersect("low_grams", "high_grams"))
    most = common + F.greatest(_left_out(F.col("low_n"), percent), _left_out(F.col("high_n"), percent))
    enough = (100 + percent) * most >= percent * (F.col("low_n").cast("long") + F.col("high_n"))
    return pairs.join(low, "low").join(high, "high").filter(enough).select("low", "high", "low_n", "high_n")


def _slot(cls: Column) -> Column:
    return F.shiftrightunsigned(cls, 64 - _FILTER_BITS)


def _links(pairs: DataFrame, texts: DataFrame, sets: Sets, order: GramOrder, percent: int, scratch: Scratch, label: str) -> DataFrame:
    """Those of the pairs that are similar. A fragment of a set is a row: the overlap of each pair is counted for each
    fragment by itself, by a join on class and fragment, and summed per pair.

    Only classes in a pair have their sets cut and sent. They are picked while the sets are read, by a bit for each
    of 2**22 hash slots; a class that only shares a slot is sent in vain and then has no pair.
    """
    taking = pairs.select(_slot(F.col("low")).alias("slot")).union(pairs.select(_slot(F.col("high")).alias("slot"))).distinct().toPandas()
    marked = np.zeros(1 << _FILTER_BITS, dtype=bool)
    marked[taking["slot"].to_numpy(np.int64)] = True
    marked = np.packbits(marked)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(marked).astype(bool)
        for cls, grams in _each_class(batches, sets):
            if wanted[(cls % 2**64) >> (64 - _FILTER_BITS)]:
                places = order.places(grams)
                bounds = [0, *np.searchsorted(places, order.pivots).tolist(), len(places)]
                filled = [(fragment, places[a:b].view(np.int64)) for fragment, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if a < b]
                columns = [pa.array([cls] * len(filled), pa.int64()), pa.array([fragment for fragment, _ in filled], pa.int32())]
                grams_of = pa.array([part for _, part in filled], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*columns, grams_of], names=["cls", "fragment", "grams"])

    # A class read by several tasks comes several times; its fragments are equal, so any will do. Both joins use this
    # one exchange.
    parts = texts.mapInArrow(cut, "cls long, fragment int, grams array<long>").groupBy("cls", "fragment").agg(F.first("grams").alias("grams"))
    low = parts.select(F.col("cls").alias("low"), "fragment", F.col("grams").alias("low_grams"))
    high = parts.select(F.col("cls").alias("high"), "fragment", F.col("grams").alias("high_grams"))
    partial = F.size(F.array_intersect("low_grams", "high_grams")).cast("long")
    # Pairs have their fragments before they meet the sets, so that both joins are on the keys the exchange deals by.
    each = pairs.withColumn("fragment", F.explode(F.sequence(F.lit(0), F.lit(len(order.pivots)))))
    each = each.join(low, ["low", "fragment"]).join(high, ["high", "fragment"]).select("low", "high", "low_n", "high_n", partial.alias("shared"))
    whole = each.groupBy("low", "high", "low_n", "high_n").agg(F.sum("shared").alias("shared"))
    similar = 100 * F.col("shared") >= percent * (F.col("low_n") + F.col("high_n") - F.col("shared"))
    return scratch.write(whole.filter(similar).select("low", "high"), f"{label}-links")


def similar_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, fragments: int = FRAGMENTS, carry: Sequence[str] = (), number: Callable[[bytes, int], int] = digest
) -> DataFrame:
    """For every row its doc_id, what is carried along, its set size, its component's smallest doc_id and `component`,
    a number that tells components apart even where rows repeat a doc_id (null for an empty set).

    Sets are distinct word n-grams (as `words.shingle_sets` has them); two link if 100 * intersection >= percent *
    union. Documents with equal sets form one class, found by a 64-bit digest, `number`. Every class is held against its size and
    another 64 bits of each of its sets first; if two sets share a digest, digests are made anew under another seed.
    Classes are joined:

    1. Count n-grams, order them from rare to frequent and cut that order into fragments of equal weight.
    2. Each class puts its rarest n-grams forward. Where an n-gram has several classes, all are paired with one of
       them, so a group of near copies becomes a star and not all its pairs.
    3. Overlaps of these pairs are counted fragment by fragment and summed; links make components.
    4. All other pairs that share enough such n-grams to be similar and lie in different components are checked likewise.
       So every link either is found or joins two that are in one component already.

    Null, empty and blank texts have an empty set and stay alone. Null doc_ids take part; a component made of them
    alone has null. Repeated rows are copies. Shingles are 64-bit hashes. Long texts are read in pieces.

    Sets are made from the texts in each step that needs them: five passes over `docs`, so it should be a stored
    table. Kept sets would take twice the room of the compressed texts.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text is not null")
    for seed in range(_TRIES):
        sets = Sets(words, number, seed)
        narrow = scratch.write(_members(docs, sets, carry), "gram-members")
        differ = (F.min("n") != F.max("n")) | (F.min("other") != F.max("other"))
        if narrow.groupBy("cls").agg(differ.alias("differ")).filter("differ").isEmpty():
            break
    else:
        raise RuntimeError(f"different sets share a digest under each of {_TRIES} seeds")
    order = _gram_order(texts, sets, fragments)
    prefixes = scratch.write(_prefixes(texts, sets, order, percent), "gram-prefixes")
    # Nearly all n-grams have one class, and go no further.
    several = prefixes.groupBy("gram").agg(F.min("cls").alias("first"), F.max("cls").alias("last")).filter("first < last")
    shared = prefixes.join(several.select("gram"), "gram").distinct()
    shared = scratch.write(shared, "gram-shared")
    scratch.drop("gram-prefixes")

    # The class with the fewest n-grams of its own before this one is the likeliest to link with the others.
    centres = shared.groupBy("gram").agg(F.min(F.struct("place", "cls", "n")).alias("centre"))
    star = shared.join(centres, "gram").filter("cls <> centre.cls")
    star = star.select("cls", "n", "place", F.col("centre.cls").alias("other"), F.col("centre.n").alias("other_n"), F.col("centre.place").alias("other_place"))
    bound = _can_link(F.col("n"), F.col("place"), F.col("other_n"), F.col("other_place"), percent)
    pairs = scratch.write(_pairs(star.filter(bound)), "star-pairs")
    links = _links(pairs, texts, sets, order, percent, scratch, "star")
    joined = scratch.write(connected_components(links, scratch, "first-stars"), "first-components")

    grams = shared.select("gram", "cls", "n", "place").join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    grams = grams.withColumn("component", F.coalesce("component", "cls"))
    grams = scratch.write(grams, "gram-components")
    mixed = grams.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("gram")
    left = grams.join(mixed, "gram", "left_semi")
    right = left.select("gram", *[F.col(c).alias(f"other_{c}") for c in ("cls", "n", "place", "component")])
    crossing = left.join(right, "gram").filter((F.col("component") < F.col("other_component")) & bound)
    rest = _pairs(crossing.withColumnRenamed("other_cls", "other")).join(pairs, ["low", "high"], "left_anti")
    rest = scratch.write(rest, "cross-candidates")
    # Every n-gram that classes of two components share is in `left`.
    rest = scratch.write(_sharing_enough(rest, left.select("cls", "gram"), percent), "cross-pairs")
    links = links.unionByName(_links(rest, texts, sets, order, percent, scratch, "cross"))
    joined = scratch.write(connected_components(links, scratch, "last-stars"), "last-components")

    scratch.drop("gram-shared", "gram-components")
    classes = narrow.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("least"))
    classes = classes.join(joined.withColumnRenamed("node", "cls"), "cls", "left")
    classes = classes.withColumn("component", F.coalesce("component", "cls"))
    labels = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = classes.select("cls", "component").join(labels, "component").select("cls", "component", "component_id")
    found = narrow.join(labelled, "cls", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return found.select("doc_id", *carry, F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), "component")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of docs less all but one of each component: the one with the smallest (doc_id, text digest).

    Documents without words all stay. Of rows that repeat both doc_id and text one stays, any of them.
    """
    text = F.col("text").cast("string")
    worded = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    key, digest, copies = (fresh_name(name, docs.columns) for name in ("_key", "_digest", "_copies"))
    narrow = docs.filter(worded).select("doc_id", "text", F.md5(text).alias(digest))
    found = similar_components(narrow, words, percent, carry=(digest,))
    first = found.groupBy("component").agg(F.min(F.struct("doc_id", digest)).alias("first"))
    rows = found.groupBy("component", "doc_id", digest).agg(F.count("*").alias(copies))
    chosen = rows.join(first, "component").filter(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col(digest) == F.col(f"first.{digest}")))
    chosen = chosen.select(F.col("doc_id").alias(key), F.col(digest).alias(f"{digest}_"), copies)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(key)) & (F.md5(text) == F.col(f"{digest}_"))
    kept = docs.filter(worded).join(chosen, same)
    single = kept.filter(F.col(copies) == 1).select(*docs.columns)
    repeated = kept.filter(F.col(copies) > 1).dropDuplicates([key, f"{digest}_"]).select(*docs.columns)
    return single.unionByName(repeated).unionByName(docs.filter(~worded))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("component")
