"""Mix sources to target weights by repeating their documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vendorium.llm.scratch import Scratch, fresh_name
from vendorium.operators.numbering import number_rows

WEIGHTS = (1, 2, 3)  # sources in code point order take them in turn
MOST_REPEATS = 3
SEED = "mix-1"
DRAWS = 64  # ways to draw that each source chooses from
_RANGE = 2**45  # draws are whole numbers below
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Add `target` to rows (source, source_size), one for each source.

    Weights go by code point order of the source, null last. A target stops at `most` times the source's size; what
    is above is dealt again by weight among the others until no target is above its limit. Each round is one
    aggregate over the sources, and only four sums of it come to the driver, so sources may be many. All sizes 0 give
    targets of 0.
    """
    missing = sizes.select(F.col("source").isNull().alias("_missing"), "source", "source_size")
    numbered = number_rows(missing, "_place", ("_missing", "source"), after=-1)
    turns = F.array(*[F.lit(weight).cast("long") for weight in weights])
    weighted = numbered.withColumn("_weight", F.get(turns, (F.col("_place") % len(weights)).cast("int")))
    limit = F.col("source_size") * most
    level, stopped = 0.0, -1
    while True:
        full = limit <= F.col("_weight") * F.lit(level) if stopped >= 0 else F.lit(False)
        row = weighted.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)),
            F.coalesce(F.sum(F.when(full, limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0)),
            F.count_if(full),
        ).first()
        total, taken, weight, now = row
        if now == stopped or not weight:
            break
        level, stopped = (total - taken) / weight, now
    target = F.least(limit.cast("double"), F.col("_weight") * F.lit(level))
    return weighted.select("source", "source_size", F.when(F.lit(total > 0), target).otherwise(F.lit(0.0)).alias("target"))


def draw_seeds(doc_id: Column, nth: Column, seed: str = SEED) -> tuple[Column, Column]:
    """Two numbers from the seed and the document's id, null as text, with a number for rows that repeat an id: the same
    in every run and engine."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.when(nth > 1, F.concat(F.lit("#"), nth.cast("string"))).otherwise(F.lit("")))
    text = F.md5(key)
    return tuple((F.conv(F.substring(text, at, 11), 16, 10).cast("long") % _RANGE).alias(f"_h{at}") for at in (1, 12))


def draw(first: Column, step: Column, way: Column | int) -> Column:
    """The draw of a document in one of the ways, in [0, 1): steps from the first number around the range."""
    return ((first + step * way) % _RANGE).cast("double") / F.lit(float(_RANGE))


def _numbered_repeats(docs: DataFrame, nth: str, digest: str) -> DataFrame:
    """Add the number of each row among those with its doc_id, by their `digest`; equal rows are interchangeable.

    Only rows whose doc_id comes again are moved, by ranges of (doc_id, digest, row), so that a frequent one is many
    tasks; without any nothing is.
    """
    key, place = (fresh_name(name, docs.columns) for name in ("_key", "_place"))
    keyed = docs.withColumn(key, F.col("doc_id").cast("string"))
    again = keyed.groupBy(key).agg(F.count("*").alias("_rows")).filter("_rows > 1").select(F.col(key).alias(f"{key}_"))
    again = Scratch(docs.sparkSession).write(again, "repeated-ids")
    if again.isEmpty():
        return docs.withColumn(nth, F.lit(1).cast("long"))
    same = F.col(key).eqNullSafe(F.col(f"{key}_"))
    once = keyed.join(again, same, "left_anti").withColumn(nth, F.lit(1).cast("long")).drop(key)
    several = keyed.join(again, same, "left_semi")
    row = fresh_name("_row", several.columns)
    several = number_rows(several.withColumn(row, F.monotonically_increasing_id()), place, (key, digest, row)).drop(row)
    first = several.groupBy(F.col(key).alias(f"{key}_")).agg(F.min(place).alias(f"{place}_"))
    placed = several.join(first, same).withColumn(nth, F.col(place) - F.col(f"{place}_") + 1)
    return once.unionByName(placed.select(*docs.columns, nth))


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """Add to each document `size` (words), `source_size`, `target` (of its source) and `copies`.

    The rate of a source is target / size; each document is taken floor(rate) times, and once more if its draw is
    below the rest. A draw is hashed from the seed and the id in `DRAWS` ways, and each source takes the way, for all
    of its documents, by which it comes nearest to its target: one aggregate finds it. Columns of `docs` with these
    names are replaced. Empty and null texts have size 0 and follow their source's rate; a source of size 0 has rate 0.
    Rows that repeat a doc_id draw each by themselves.
    """
    new = ("size", "source_size", "target", "copies")
    kept = [name for name in docs.columns if name.lower() not in new]
    marked, own = fresh_name("_source", kept), fresh_name("_of", kept)
    nth, first, step, way, digest = (fresh_name(name, kept) for name in ("_nth", "_first", "_step", "_way", "_digest"))
    scratch = Scratch(docs.sparkSession)
    text = F.col("text").cast("string")
    # Sizes and digests first: where only numbers are wanted, repeated rows are moved without their texts.
    measured = docs.select(*kept, word_count(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias(digest))
    repeats = _numbered_repeats(measured, nth, digest)
    hashes = [number.alias(name) for number, name in zip(draw_seeds(F.col("doc_id"), F.col(nth), seed), (first, step), strict=True)]
    sized = repeats.select(*kept, "size", *hashes, F.col("source").cast("string").alias(marked))
    # Numbers only: texts are not written, and their words are counted once for all that follows.
    narrow = scratch.write(sized.select(marked, "size", first, step), "source-words")
    sizes = scratch.write(narrow.groupBy(F.col(marked).alias("source")).agg(F.sum("size").alias("source_size")), "source-sizes")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = source_targets(sizes, weights, most).withColumnsRenamed({"source": own})
    targets = scratch.write(targets.withColumn("_whole", F.floor(rate).cast("long")).withColumn("_rest", rate - F.floor(rate)), "source-targets")
    same = F.col(marked).eqNullSafe(F.col(own))
    extra = [F.sum(F.when(draw(F.col(first), F.col(step), k) < F.col("_rest"), F.col("size")).otherwise(0)) for k in range(DRAWS)]
    taken = narrow.join(targets, same).groupBy(own).agg(F.first("_whole").alias("_whole"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.array(*extra).alias("_extra"))
    misses = F.transform("_extra", lambda more, k: F.struct(F.abs(F.col("_whole") * F.col("source_size") + more - F.col("target")).alias("miss"), k.alias("way")))
    ways = scratch.write(taken.select(F.col(own).alias(f"{own}_"), F.array_min(misses)["way"].alias(way)), "source-ways")
    chosen = targets.join(ways, F.col(own).eqNullSafe(F.col(f"{own}_"))).drop(f"{own}_")
    joined = sized.join(chosen, same)
    copies = F.col("_whole") + (draw(F.col(first), F.col(step), F.col(way)) < F.col("_rest")).cast("long")
    return joined.select(*kept, "size", "source_size", "target", copies.cast("long").alias("copies"))


def emit(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The mixture itself: these columns of each document, as often as it is taken."""
    copy = fresh_name("_copy", mixed.columns)
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mixed.filter("copies > 0").select(*columns, times.alias(copy)).select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixed = mix_documents(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH RECURSIVE sized AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS text_md5, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), rounds AS (
    SELECT 0 AS round, 0.0::DOUBLE AS level, -1::BIGINT AS stopped
    UNION ALL
    SELECT round + 1, (total - taken)::DOUBLE / weights, now FROM (
        SELECT r.round, r.stopped, sum(source_size)::BIGINT AS total,
               coalesce(sum(3 * source_size) FILTER (WHERE r.stopped >= 0 AND 3 * source_size <= weight * r.level), 0)::BIGINT AS taken,
               sum(weight) FILTER (WHERE NOT (r.stopped >= 0 AND 3 * source_size <= weight * r.level))::BIGINT AS weights,
               count(*) FILTER (WHERE r.stopped >= 0 AND 3 * source_size <= weight * r.level)::BIGINT AS now
        FROM rounds r, sources GROUP BY r.round, r.stopped, r.level
    ) WHERE now <> stopped AND weights > 0
), targets AS (
    SELECT source, source_size,
           least((3 * source_size)::DOUBLE, weight * (SELECT level FROM rounds ORDER BY round DESC LIMIT 1)) AS target
    FROM sources
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY text_md5) AS nth FROM sized
), rated AS (
    SELECT doc_id, size, targets.source, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
           md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null') || CASE WHEN nth > 1 THEN '#' || nth ELSE '' END) AS hash
    FROM numbered JOIN targets ON numbered.source IS NOT DISTINCT FROM targets.source
), hashed AS (
    SELECT *, floor(rate)::BIGINT AS whole, rate - floor(rate) AS rest, ('0x' || substr(hash, 1, 11))::BIGINT % 35184372088832 AS first,
           ('0x' || substr(hash, 12, 11))::BIGINT % 35184372088832 AS step
    FROM rated
), drawn AS (
    SELECT *, whole + (((first + step * way) % 35184372088832)::DOUBLE / 35184372088832.0 < rest)::BIGINT AS copies
    FROM hashed, (SELECT unnest(range(64)) AS way)
), ways AS (
    SELECT source, way FROM drawn GROUP BY source, way, target
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(sum(copies * size) - target), way) = 1
)
SELECT doc_id, size, source_size, target, copies * size AS taken
FROM drawn JOIN ways ON drawn.way = ways.way AND drawn.source IS NOT DISTINCT FROM ways.source
"""
