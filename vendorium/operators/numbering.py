"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from vendorium.session import materialize

_LOCAL_BITS = 33  # `monotonically_increasing_id` keeps the row's place in its partition in the low 33 bits


def number_rows(df: DataFrame, name: str, order: Sequence[str] = (), after: int = 0) -> DataFrame:
    """Add `name` = after+1, after+2, ..., in the given order, which must be unique, or as the rows lie.

    The rows are written out once, each with its partition and its place in it. A running
    total over one row per partition gives each partition's offset, so no task sees more
    than its own rows. Writing first matters: ranges come from a sample, and a second
    evaluation could cut them elsewhere. Without an order nothing is shuffled.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    stored = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), name)
    part = F.shiftright("_place", _LOCAL_BITS)
    local = F.col("_place").bitwiseAND((1 << _LOCAL_BITS) - 1)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition of `stored`, whatever the size of the data.
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    key = (F.lit(after) + F.col("_offset") + local + 1).cast("long")
    return numbered.select(key.alias(name), *df.columns)
