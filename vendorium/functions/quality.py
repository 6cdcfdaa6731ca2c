"""Data-quality rules, written once as (code, condition) and used for both the flag and the reason."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_blank(column: str) -> Column:
    """NULL or nothing but spaces; a tab is not a space."""
    return F.col(column).isNull() | (F.trim(column) == "")


def _outside_percent(column: str) -> Column:
    return ~F.col(column).between(0, 100)


def rules() -> list[tuple[str, Column]]:
    """Codes in the order in which a rejection reason lists them."""
    return [
        ("NULL_SUPPLIER_ID", F.col("supplier_id").isNull()),
        ("BLANK_SUPPLIER_NAME", is_blank("supplier_name")),
        ("BLANK_REGION", is_blank("region")),
        ("BLANK_COUNTRY_CODE", is_blank("country_code")),
        ("NULL_QUALITY_SCORE", F.col("quality_score").isNull()),
        ("QUALITY_SCORE_OUT_OF_RANGE", _outside_percent("quality_score")),
        ("NULL_ON_TIME_DELIVERY", F.col("on_time_delivery_pct").isNull()),
        ("ON_TIME_DELIVERY_OUT_OF_RANGE", _outside_percent("on_time_delivery_pct")),
        ("NULL_CONTRACT_VALUE", F.col("contract_value_usd").isNull()),
        ("NEGATIVE_CONTRACT_VALUE", F.col("contract_value_usd") < 0),
        ("NULL_LEAD_TIME", F.col("lead_time_days").isNull()),
        ("NEGATIVE_LEAD_TIME", F.col("lead_time_days") < 0),
    ]


def broken(condition: Column) -> Column:
    """A rule is broken only if its condition is true; unknown counts as not broken."""
    return F.coalesce(condition, F.lit(False))


def dq_passed() -> Column:
    any_broken = F.lit(False)
    for _, condition in rules():
        any_broken = any_broken | broken(condition)
    return ~any_broken


def rejection_reason() -> Column:
    """Codes of all broken rules joined by ' | '; `concat_ws` leaves out the NULLs of unbroken ones."""
    return F.concat_ws(" | ", *[F.when(condition, F.lit(code)) for code, condition in rules()])
