"""Ranks over the whole table, and within a few large groups, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from vendorium.session import materialize

# Width of a score bucket in points, and how many buckets make one of the next level.
# A score moves by 2/3 of a point per day of lead time and spans 80 points otherwise, in steps of 0.004. So a bucket
# is reached by at most 122 lead times with 251 steps each: some 30,000 distinct scores, and usual scores (0 to 100)
# fill a hundred buckets. The whole INT range of lead times fills no more than 150,000 buckets of the last level.
# Neither figure depends on the number of rows.
BUCKETS = (1, 10_000)


def _join_keeping_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which NULL keys are equal; the key columns come once, from the left."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    same = [left[key].eqNullSafe(renamed[f"_right_{key}"]) for key in keys]
    return left.join(renamed, same).drop(*[f"_right_{key}" for key in keys])


def rows_above(counts: DataFrame, value: str, by: Sequence[str] = (), widths: Sequence[int] = BUCKETS) -> DataFrame:
    """For each distinct `value` (within `by`), the rows that have a greater one.

    `counts` has one row per `by` and `value` with its number of rows `n`. The sum is
    taken inside a bucket of values, and recursively over the buckets above it. NULL values come before all others.
    """
    if not widths:
        above = Window.partitionBy(*by).orderBy(F.desc_nulls_first(value)).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("above", F.coalesce(F.sum("n").over(above), F.lit(0)))
    bucket = f"_bucket{len(widths)}"
    bucketed = counts.withColumn(bucket, F.floor(F.col(value) / widths[0]))
    inside = rows_above(bucketed, value, [*by, bucket], ())
    totals = bucketed.groupBy(*by, bucket).agg(F.sum("n").alias("n"))
    higher = rows_above(totals, bucket, by, widths[1:]).withColumnRenamed("above", "_higher").drop("n")
    joined = _join_keeping_nulls(inside, higher, [*by, bucket])
    return joined.withColumn("above", F.col("above") + F.col("_higher")).select(*by, value, "n", "above")


def score_ranks(df: DataFrame, score: str, group: str) -> DataFrame:
    """Per group and score: `rank_in_group`, `overall_rank` (both RANK, greatest first) and `total_rows`.

    The rows are only counted per group and score, which needs no more than a partial
    aggregate per task. The counts are written out, as every running sum starts from them
    and would otherwise scan the rows again.
    """
    counts = materialize(df.groupBy(group, score).agg(F.count("*").alias("n")), "score_counts")
    in_group = rows_above(counts, score, [group]).select(group, score, (F.col("above") + 1).alias("rank_in_group"))
    per_score = counts.groupBy(score).agg(F.sum("n").alias("n"))
    overall = rows_above(per_score, score).select(score, (F.col("above") + 1).alias("overall_rank"))
    total = counts.agg(F.sum("n").alias("total_rows")).scalar()
    return _join_keeping_nulls(in_group, overall, [score]).withColumn("total_rows", total)


def rank_by_score(df: DataFrame, score: str, group: str) -> DataFrame:
    """Add the ranks to every row.

    The join is on group and score with a unique right side, so it is broadcast when small
    and split by adaptive execution when one score is hot.
    """
    return _join_keeping_nulls(df, score_ranks(df, score, group), [group, score])
