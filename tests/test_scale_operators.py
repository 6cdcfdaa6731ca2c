"""Ranks, surrogate keys and averages against brute force, and the shape of their plans."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from samples import raw_rows
from vendorium.functions.scalars import exact_avg, file_stem, performance_score, seconds_between
from vendorium.operators.latest import latest_per_key
from vendorium.operators.numbering import number_rows
from vendorium.operators.ranking import BUCKETS, rank_by_score
from vendorium.operators.routing import accepted, flag


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("spread", [3, 5000])
def test_ranks_match_brute_force(spark, spread):
    chance = random.Random(spread)
    rows = [(n, chance.choice("AAB"), Decimal(chance.randrange(-spread, spread)) / 7) for n in range(400)]
    rows += [(n, "A", Decimal(1)) for n in range(400, 600)]  # one hot score
    df = spark.createDataFrame(rows, "id int, g string, score decimal(24,7)").cache()
    scores = [(row.id, row.g, row.score) for row in df.collect()]
    found = {row.id: row for row in rank_by_score(df, "score", "g").collect()}
    assert len(found) == len(rows)
    for key, group, score in scores:
        row = found[key]
        assert row.overall_rank == 1 + sum(s > score for _, _, s in scores)
        assert row.rank_in_group == 1 + sum(s > score for _, g, s in scores if g == group)
        assert row.total_rows == len(rows)


def test_ranks_keep_nulls(spark):
    """NULL scores come first, as DESC has them in the rules' dialect; a NULL group is a group."""
    rows = [(1, "A", 5), (2, "A", None), (3, None, 7), (4, None, 5), (5, "A", None)]
    df = spark.createDataFrame(rows, "id int, g string, score int").withColumn("score", F.col("score").cast("decimal(24,7)"))
    found = {row.id: (row.g, row.rank_in_group, row.overall_rank, row.total_rows) for row in rank_by_score(df, "score", "g").collect()}
    assert found == {1: ("A", 3, 4, 5), 2: ("A", 1, 1, 5), 3: (None, 1, 3, 5), 4: (None, 2, 4, 5), 5: ("A", 1, 1, 5)}


def test_no_bucket_holds_many_scores(spark):
    """Scores of usual lead times, in steps of 0.004 over 80 points, meet in small shares."""
    scores = spark.range(20001).select((F.col("id") * 4 / 1000).alias("score"))
    buckets = scores.groupBy(F.floor(F.col("score") / BUCKETS[0])).count()
    assert buckets.agg(F.max("count")).first()[0] <= 0.03 * 20001


def test_ranking_needs_no_group_in_one_task(spark):
    """The rows themselves are only counted and joined; windows run over counts."""
    df = spark.range(1000).select((F.col("id") % 7).cast("decimal(24,7)").alias("score"), F.lit("A").alias("g"))
    windows = _plan(rank_by_score(df, "score", "g")).split("Window [")[1:]
    assert windows and all(part.startswith("sum(n#") for part in windows)


def test_numbers_are_dense_and_ordered(spark):
    keys = list(range(1000))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(f"K{k:04d}",) for k in keys], "k string").repartition(6)
    rows = number_rows(df, "sk", ("k",), after=50).orderBy("k").collect()
    assert [row.sk for row in rows] == list(range(51, 1051))


def test_numbering_nothing(spark):
    assert number_rows(spark.createDataFrame([], "k string"), "sk", ("k",)).count() == 0


def test_latest_reduces_before_the_shuffle(spark):
    plan = _plan(latest_per_key(accepted(flag(raw_rows(spark, {}, {})))))
    final, partial = plan.index("1, Final"), plan.index("1, Partial")
    assert final < plan.index("Exchange hashpartitioning") < partial


def test_average_rounds_half_up_once(spark):
    values = [Decimal("0.01"), Decimal("0.02")] * 3 + [Decimal("99.99")]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(5,2)")
    want = (sum(values) / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert df.agg(exact_avg("v", 2).alias("a")).first().a == want
    half = spark.createDataFrame([(Decimal("0.01"),), (Decimal("0.02"),)], "v decimal(5,2)")
    assert half.agg(exact_avg("v", 2).alias("a")).first().a == Decimal("0.02")


def test_score_goes_below_zero_weight_past_thirty_days(spark):
    df = raw_rows(spark, {"lead_time_days": 45, "quality_score": Decimal("50"), "on_time_delivery_pct": Decimal("50")})
    assert df.select(F.round(performance_score(), 2).alias("s")).first().s == Decimal("30.00")


def test_seconds_count_boundaries(spark):
    row = spark.sql(
        "SELECT timestamp_ntz'2024-01-01 23:59:59.900' AS a, timestamp_ntz'2024-01-02 00:00:00.100' AS b"
    ).select(seconds_between(F.col("a"), F.col("b")).alias("s"), seconds_between(F.col("a"), F.col("a")).alias("z"))
    assert tuple(row.first()) == (1, 0)


def test_file_stem(spark):
    df = spark.createDataFrame([("a/b/c.d.csv",), ("x",), ("dir.v1/name.csv.gz",)], "p string")
    assert [row[0] for row in df.select(file_stem(F.col("p"))).collect()] == ["c", "x", "name"]
