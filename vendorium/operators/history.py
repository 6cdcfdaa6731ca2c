"""Current state and Type-2 history: hash-compared upsert, expire, open, and rebuild in one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vendorium.schemas import BUSINESS_COLUMNS, SUPPLIERS_CLEAN

KEY = ("supplier_id",)


def upsert(target: DataFrame, source: DataFrame, load_ts: Column) -> DataFrame:
    """New current state. `source` holds one row per key.

    Unknown keys are inserted, keys whose hash differs are replaced and take `load_ts`,
    all others keep their row as it is. The target is read once.
    """
    values = [name for name in SUPPLIERS_CLEAN.names if name != "supplier_id"]
    old = target.select("supplier_id", F.struct(*values).alias("old"))
    new = source.withColumn("load_ts", load_ts).select("supplier_id", F.struct(*values).alias("new"))
    replace = F.col("new").isNotNull() & (
        F.col("old").isNull() | (F.col("old.record_hash") != F.col("new.record_hash"))
    )
    chosen = F.when(replace, F.col("new")).otherwise(F.col("old"))
    merged = old.join(new, "supplier_id", "full_outer").select("supplier_id", chosen.alias("row"))
    return merged.select("supplier_id", "row.*").select(*SUPPLIERS_CLEAN.names)


def _same_key(left: str, right: str, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{left}.{key}") == F.col(f"{right}.{key}"))
    return condition


def changed(current: DataFrame, state: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Current versions whose key is in `state` with another hash: the ones to expire."""
    differs = F.col("c.record_hash") != F.col("s.record_hash")
    other = state.select(*keys, "record_hash").alias("s")
    return current.alias("c").join(other, _same_key("c", "s", keys) & differs, "left_semi")


def expire(versions: DataFrame, valid_to: Column) -> DataFrame:
    return versions.withColumn("is_current", F.lit(False)).withColumn("valid_to", valid_to)


def without_current(state: DataFrame, current: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """Rows of `state` whose key has no current version: the ones to open."""
    return state.join(current.select(*keys), list(keys), "left_anti")


def as_versions(rows: DataFrame, valid_from: Column, valid_to: Column | None = None) -> DataFrame:
    """Shape accepted rows as versions, open unless `valid_to` says otherwise; no surrogate key yet."""
    end = F.lit(None).cast("timestamp_ntz") if valid_to is None else valid_to
    return rows.select(
        *BUSINESS_COLUMNS,
        F.lit(True).alias("dq_passed"),
        F.lit(None).cast("string").alias("dq_fail_reasons"),
        "record_hash",
        valid_from.alias("valid_from"),
        end.alias("valid_to"),
        end.isNull().alias("is_current"),
        "source_file_name",
        "source_row_number",
        valid_from.alias("load_ts"),
    )


def fold(dimension: DataFrame, batch: DataFrame, run_ts: Column) -> DataFrame:
    """Expire and open for one batch over a whole dimension, reading the dimension once.

    Every joined key yields its old version, its new version, or both. Closed versions
    match nothing and pass through, so a chain of folds stays one straight plan.
    """
    old = dimension.select(F.struct(*dimension.columns).alias("old"))
    new = as_versions(batch, run_ts).select(F.struct(*dimension.columns).alias("new"))
    meets = (F.col("old.supplier_id") == F.col("new.supplier_id")) & F.col("old.is_current")
    replaced = F.coalesce(F.col("old.record_hash") != F.col("new.record_hash"), F.lit(False))
    closed = F.col("old").withField("valid_to", run_ts).withField("is_current", F.lit(False))
    rows = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(replaced, F.array(closed, F.col("new")))
        .otherwise(F.array("old"))
    )
    return old.join(new, meets, "full_outer").select(F.inline(rows))


def open_versions(deliveries: DataFrame, known: DataFrame, run_ts: Column, order: Sequence[str]) -> DataFrame:
    """All versions that one batch opens, also where it delivers a supplier several times.

    `known` has the record hash of each open version, `order` sorts a supplier's deliveries. A delivery opens a version
    if its hash differs from the one before, the first from the open version; the next one closes it. Versions of one
    supplier start a microsecond apart, the first at `run_ts`, so that intervals meet and none is empty. Deliveries of
    a supplier are as many as files in the batch, whatever their rows.
    """
    timeline = Window.partitionBy("supplier_id").orderBy(*order)
    before = known.select("supplier_id", F.col("record_hash").alias("_open_hash"))
    known_hash = F.coalesce(F.lag("record_hash").over(timeline), F.col("_open_hash"))
    marked = deliveries.join(before, "supplier_id", "left").withColumn("_before", known_hash)
    opened = marked.filter(F.col("_before").isNull() | (F.col("_before") != F.col("record_hash")))
    nth = (F.row_number().over(timeline) - 1).cast("decimal(18,6)") / 1_000_000
    start = run_ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), nth.cast("decimal(18,6)"))
    begun = opened.withColumn("_start", start)
    ended = begun.withColumn("_end", F.lead("_start").over(timeline))
    return as_versions(ended, F.col("_start"), F.col("_end"))


def rebuild(deliveries: DataFrame) -> DataFrame:
    """Whole history in one pass from all accepted deliveries, one row per key and batch.

    A delivery opens a version if its hash differs from the one before, and the next
    version closes it. A key has at most one row per batch here, so even the busiest
    key's window holds no more rows than there were batches.
    """
    timeline = Window.partitionBy("supplier_id").orderBy("load_ts")
    previous = F.lag("record_hash").over(timeline)
    opens = previous.isNull() | (previous != F.col("record_hash"))
    opened = deliveries.withColumn("_opens", opens).filter("_opens")
    ended = opened.withColumn("_valid_to", F.lead("load_ts").over(timeline))
    return as_versions(ended, F.col("load_ts"), F.col("_valid_to"))


def clean_state(dimension: DataFrame) -> DataFrame:
    """The current-state table: open versions, which by construction carry the same values."""
    return dimension.filter("is_current").select(*SUPPLIERS_CLEAN.names)


def version_counts(dimension: DataFrame) -> DataFrame:
    return dimension.groupBy("is_current").agg(F.count("*").alias("versions"))


def reconcile(clean: DataFrame, dimension: DataFrame) -> DataFrame:
    """Keys on which current state and open versions disagree, in hash or in presence."""
    state = clean.select("supplier_id", F.col("record_hash").alias("clean_hash"))
    open_ = dimension.filter("is_current").select("supplier_id", F.col("record_hash").alias("dim_hash"))
    both = state.join(open_, "supplier_id", "full_outer")
    return both.filter(~F.col("clean_hash").eqNullSafe(F.col("dim_hash")))
