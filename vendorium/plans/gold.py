"""Gold summaries over the current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vendorium.functions.scalars import (
    count_where,
    days_since,
    exact_avg,
    percentage,
    performance_score,
    risk_level,
)
from vendorium.operators.ranking import rank_by_score, score_ranks
from vendorium.schemas import AGG_RISK_SPEND, GOLD_STATE, KPI_SNAPSHOT, conform

OVERDUE_DAYS = 365  # fixed value


def _risk_is(rating: str) -> Column:
    return F.col("risk_rating") == rating


def _money() -> list[Column]:
    return [
        F.count("*").alias("supplier_count"),
        F.sum("contract_value_usd").alias("total_contract_value"),
    ]


def _averages(on_time: str = "avg_on_time_delivery_pct") -> list[Column]:
    return [
        exact_avg("quality_score", 2).alias("avg_quality_score"),
        exact_avg("on_time_delivery_pct", 2).alias(on_time),
        exact_avg("lead_time_days", 1, "bigint").alias("avg_lead_time_days"),
    ]


def _avg_contract() -> Column:
    return exact_avg("contract_value_usd", 2, "decimal(18,2)").alias("avg_contract_value")


def _high_risk() -> Column:
    return count_where(_risk_is("HIGH")).alias("high_risk_count")


def regional_summary(clean: DataFrame) -> DataFrame:
    return clean.groupBy("region").agg(
        *_money(),
        _avg_contract(),
        *_averages(),
        _high_risk(),
        count_where(_risk_is("MEDIUM")).alias("medium_risk_count"),
        count_where(_risk_is("LOW")).alias("low_risk_count"),
        count_where(F.col("is_active")).alias("active_suppliers"),
    )


def category_summary(clean: DataFrame) -> DataFrame:
    return clean.groupBy("category").agg(*_money(), _avg_contract(), *_averages(), _high_risk())


def monthly_trends(clean: DataFrame) -> DataFrame:
    """By month of the last audit and region; suppliers never audited form their own month."""
    by_month = clean.groupBy(F.trunc("last_audit_date", "MM").alias("audit_month"), "region")
    return by_month.agg(*_money(), *_averages(), _high_risk()).orderBy("audit_month", "region")


def risk_scorecard(clean: DataFrame, as_of: Column) -> DataFrame:
    """Suppliers rated HIGH or below the quality or delivery thresholds, with level and audit age."""
    age = days_since("last_audit_date", as_of)
    flagged = _risk_is("HIGH") | (F.col("quality_score") < 75) | (F.col("on_time_delivery_pct") < 60)
    return clean.filter(flagged).select(
        "supplier_id",
        "supplier_name",
        "region",
        "category",
        "country_code",
        "contract_value_usd",
        "quality_score",
        "on_time_delivery_pct",
        "lead_time_days",
        "risk_rating",
        "last_audit_date",
        risk_level().alias("risk_level"),
        age.alias("days_since_audit"),
        F.coalesce(age > OVERDUE_DAYS, F.lit(False)).alias("audit_overdue"),
    )


def supplier_rankings(clean: DataFrame) -> DataFrame:
    """Score, rank in region and overall, and tier: best and worst fifth by overall rank."""
    return _ranked_columns(rank_by_score(clean.withColumn("_score", performance_score()), "_score", "region"))


def best_suppliers(clean: DataFrame, n: int) -> DataFrame:
    """The first `n` of the rankings; the id decides between equal ranks.

    Rank order is score order, so each task keeps its best `n` rows and only those meet the ranks.
    """
    scored = clean.withColumn("_score", performance_score())
    best = scored.orderBy(F.desc("_score"), "supplier_id").limit(n)
    return _ranked_columns(best.join(score_ranks(scored, "_score", "region"), ["region", "_score"]))


def _ranked_columns(ranked: DataFrame) -> DataFrame:
    fifth = F.col("total_rows") * F.lit("0.2").cast("decimal(2,1)")
    four_fifths = F.col("total_rows") * F.lit("0.8").cast("decimal(2,1)")
    tier = (
        F.when(F.col("overall_rank") <= F.ceil(fifth), "TIER_1_TOP")
        .when(F.col("overall_rank") >= F.ceil(four_fifths), "TIER_3_BOTTOM")
        .otherwise("TIER_2_MID")
    )
    return ranked.select(
        "supplier_id",
        "supplier_name",
        "region",
        "category",
        "country_code",
        "contract_value_usd",
        "quality_score",
        "on_time_delivery_pct",
        "lead_time_days",
        "risk_rating",
        F.round("_score", 2).alias("performance_score"),
        F.col("rank_in_group").alias("rank_in_region"),
        "overall_rank",
        tier.alias("performance_tier"),
    )


def agg_risk_spend(clean: DataFrame, refreshed_ts: Column) -> DataFrame:
    grouped = clean.groupBy("region", "category", "risk_rating").agg(*_money(), *_averages("avg_on_time_pct"))
    return conform(grouped.withColumn("last_refreshed_ts", refreshed_ts), AGG_RISK_SPEND)


def dq_pass_rate(dimension: DataFrame) -> DataFrame:
    """Share of open versions that passed; NULL when there are none."""
    passed = count_where(F.col("dq_passed"))
    return dimension.filter("is_current").agg(percentage(passed, F.count("*")).alias("dq_pass_rate_pct"))


def kpi_snapshot(clean: DataFrame, dimension: DataFrame, as_of: Column, snapshot_ts: Column) -> DataFrame:
    """One row of figures, also on empty input; the pass rate comes in as a scalar subquery."""
    figures = clean.agg(
        F.count("*").alias("total_suppliers"),
        count_where(F.col("is_active")).alias("active_suppliers"),
        F.sum("contract_value_usd").alias("total_contract_value"),
        exact_avg("quality_score", 2).alias("avg_quality_score"),
        exact_avg("on_time_delivery_pct", 2).alias("avg_on_time_pct"),
        _high_risk(),
        count_where(_risk_is("HIGH") & (F.col("quality_score") < 75)).alias("critical_risk_count"),
        count_where(days_since("last_audit_date", as_of) > OVERDUE_DAYS).alias("audit_overdue_count"),
    )
    row = figures.withColumns({"dq_pass_rate_pct": dq_pass_rate(dimension).scalar(), "snapshot_ts": snapshot_ts})
    return conform(row, KPI_SNAPSHOT)


# Gold from changes: a state of counts and exact sums, to which opened versions are added and closed ones taken away.

_STATE_KEYS = ("region", "category", "risk_rating", "last_audit_date")


def state_of(versions: DataFrame, sign: Column | None = None) -> DataFrame:
    """Counts and sums of versions, each taken `sign` times, by the keys of Gold's groups and the audit day."""
    sign = F.lit(1) if sign is None else sign

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, sign).otherwise(0))

    def total(name: str) -> Column:
        return F.sum(F.col(name) * sign)

    grouped = versions.groupBy(*_STATE_KEYS).agg(
        F.sum(sign).alias("suppliers"),
        count(F.col("is_active")).alias("active"),
        count(_risk_is("HIGH") & (F.col("quality_score") < 75)).alias("critical"),
        count(F.col("dq_passed")).alias("passed"),
        total("contract_value_usd").alias("contract_value"),
        total("quality_score").alias("quality"),
        count(F.col("quality_score").isNotNull()).alias("quality_known"),
        total("on_time_delivery_pct").alias("on_time"),
        count(F.col("on_time_delivery_pct").isNotNull()).alias("on_time_known"),
        total("lead_time_days").alias("lead_time"),
        count(F.col("lead_time_days").isNotNull()).alias("lead_time_known"),
    )
    return conform(grouped, GOLD_STATE)


def state_change(changes: DataFrame) -> DataFrame:
    """What opened and closed versions change: one more, one less, or nothing for those closed as soon as opened."""
    sign = F.when(F.col("is_current"), 1).when(F.col("_was_open"), -1).otherwise(0)
    return state_of(changes, sign)


def merged_state(state: DataFrame, change: DataFrame) -> DataFrame:
    figures = [name for name in GOLD_STATE.names if name not in _STATE_KEYS]
    summed = state.unionByName(change).groupBy(*_STATE_KEYS).agg(*[F.sum(name).alias(name) for name in figures])
    return conform(summed.filter("suppliers <> 0"), GOLD_STATE)


def _state_avg(total: str, known: str, digits: int) -> Column:
    """As `exact_avg`: one division of an exact sum, to 12 decimals, then rounded half up."""
    return F.round(F.sum(total).cast("decimal(28,2)") / F.nullif(F.sum(known), F.lit(0)), digits)


def agg_risk_spend_of(state: DataFrame, refreshed_ts: Column) -> DataFrame:
    grouped = state.groupBy("region", "category", "risk_rating").agg(
        F.sum("suppliers").alias("supplier_count"),
        F.sum("contract_value").alias("total_contract_value"),
        _state_avg("quality", "quality_known", 2).alias("avg_quality_score"),
        _state_avg("on_time", "on_time_known", 2).alias("avg_on_time_pct"),
        _state_avg("lead_time", "lead_time_known", 1).alias("avg_lead_time_days"),
    )
    return conform(grouped.withColumn("last_refreshed_ts", refreshed_ts), AGG_RISK_SPEND)


def kpi_snapshot_of(state: DataFrame, as_of: Column, snapshot_ts: Column) -> DataFrame:
    """The same row as `kpi_snapshot`, from one aggregate over the state."""
    overdue = days_since("last_audit_date", as_of) > OVERDUE_DAYS
    row = state.agg(
        F.coalesce(F.sum("suppliers"), F.lit(0)).alias("total_suppliers"),
        F.sum("active").alias("active_suppliers"),
        F.sum("contract_value").alias("total_contract_value"),
        _state_avg("quality", "quality_known", 2).alias("avg_quality_score"),
        _state_avg("on_time", "on_time_known", 2).alias("avg_on_time_pct"),
        F.sum(F.when(_risk_is("HIGH"), F.col("suppliers")).otherwise(0)).alias("high_risk_count"),
        F.sum("critical").alias("critical_risk_count"),
        F.sum(F.when(overdue, F.col("suppliers")).otherwise(0)).alias("audit_overdue_count"),
        percentage(F.sum("passed"), F.sum("suppliers")).alias("dq_pass_rate_pct"),
    )
    return conform(row.withColumn("snapshot_ts", snapshot_ts), KPI_SNAPSHOT)
