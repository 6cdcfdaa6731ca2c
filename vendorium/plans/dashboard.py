"""The dashboard's reads: headline figures, chart columns, filters and short lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vendorium.functions.scalars import count_where, exact_avg
from vendorium.plans.gold import best_suppliers, category_summary, regional_summary, risk_scorecard


def headline_figures(clean: DataFrame) -> DataFrame:
    return clean.agg(
        F.count("*").alias("total_suppliers"),
        count_where(F.col("is_active")).alias("active_suppliers"),
        F.round(F.sum("contract_value_usd"), 0).alias("total_contract_value"),
        exact_avg("quality_score", 1).alias("avg_quality_score"),
        exact_avg("on_time_delivery_pct", 1).alias("avg_on_time_pct"),
        count_where(F.col("risk_rating") == "HIGH").alias("high_risk_count"),
    )


def regional_charts(clean: DataFrame) -> DataFrame:
    return regional_summary(clean).select("region", "supplier_count", "avg_quality_score")


def category_charts(clean: DataFrame) -> DataFrame:
    return category_summary(clean).select("category", "total_contract_value", "avg_on_time_delivery_pct")


def risk_list(clean: DataFrame, as_of: Column, levels: Sequence[str] | None = None) -> DataFrame:
    """Scorecard rows of the chosen levels, by level name descending, then worst quality first.

    The id comes last in the order so that a hot level and score can be split over tasks.
    """
    rows = risk_scorecard(clean, as_of).select(
        "supplier_id",
        "supplier_name",
        "region",
        "category",
        "quality_score",
        "on_time_delivery_pct",
        "risk_rating",
        "risk_level",
        "days_since_audit",
        "audit_overdue",
    )
    if levels is not None:
        rows = rows.filter(F.col("risk_level").isin(*levels))
    return rows.orderBy(F.desc("risk_level"), "quality_score", "supplier_id")


def risk_levels(clean: DataFrame, as_of: Column) -> DataFrame:
    return risk_scorecard(clean, as_of).select("risk_level").distinct()


def top_suppliers(clean: DataFrame, n: int = 20) -> DataFrame:
    """The best `n` by overall rank; the id decides between equal ranks."""
    best = best_suppliers(clean, n).orderBy("overall_rank", "supplier_id")
    return best.select(
        "supplier_name",
        "region",
        "category",
        "performance_score",
        "overall_rank",
        "rank_in_region",
        "performance_tier",
    )


def tier_distribution(clean: DataFrame, n: int = 20) -> DataFrame:
    return top_suppliers(clean, n).groupBy("performance_tier").agg(F.count("*").alias("suppliers"))
