"""Small expressions shared by several jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Attributes in the order in which the record hash joins them (the key is left out).
HASHED = (
    "supplier_name",
    "country_code",
    "region",
    "category",
    "contract_value_usd",
    "lead_time_days",
    "quality_score",
    "on_time_delivery_pct",
    "risk_rating",
    "last_audit_date",
    "is_active",
)
# Text columns that are upper-cased and trimmed before storage.
STANDARDISED = ("supplier_name", "country_code", "region", "category", "risk_rating")


def standardise(column: str) -> Column:
    return F.trim(F.upper(column))


def record_hash(columns: Sequence[str] = HASHED) -> Column:
    """MD5 over the attributes joined by '|', NULL counting as empty text."""
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in columns]
    return F.md5(F.concat_ws("|", *parts))


def file_stem(path: Column) -> Column:
    """Last path part, up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def count_where(condition: Column) -> Column:
    """SUM(CASE ...): NULL on empty input, unlike `count_if`."""
    return F.sum(F.when(condition, 1).otherwise(0))


def exact_avg(column: str, digits: int, summed_as: str = "decimal(8,2)") -> Column:
    """Average rounded half up, from one sum and one division to 12 decimals.

    `avg` over decimals keeps fewer digits, so a final `round` could round twice.
    Percent columns sum in decimal(18,2), which aggregates as a plain long.
    """
    total = F.sum(F.col(column).cast(summed_as)).cast("decimal(28,2)")
    return F.round(total / F.count(column), digits)


def percentage(part: Column, whole: Column) -> Column:
    """part * 100 / whole with two digits, NULL when whole is zero."""
    return F.round(part * F.lit(100).cast("decimal(3,0)") / F.nullif(whole, F.lit(0)), 2)


def clock_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch of a zone-less timestamp, fraction dropped."""
    return (
        F.unix_date(ts.cast("date")).cast("long") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries crossed, which is not the elapsed time in seconds."""
    return clock_seconds(end) - clock_seconds(start)


def days_since(day: str, as_of: Column) -> Column:
    return F.datediff(as_of, F.col(day))


def performance_score() -> Column:
    """40 % quality, 40 % on-time delivery, 20 % inverse lead time; below zero weight past 30 days."""
    lead_share = (F.col("lead_time_days") / F.lit(30).cast("decimal(3,1)")).cast("decimal(17,6)")
    weight = F.lit("0.4").cast("decimal(2,1)")
    return (
        F.col("quality_score") * weight
        + F.col("on_time_delivery_pct") * weight
        + (F.lit(1) - lead_share) * F.lit(20)
    ).cast("decimal(24,7)")


def risk_level() -> Column:
    high, quality = F.col("risk_rating") == "HIGH", F.col("quality_score")
    return (
        F.when(high & (quality < 75), "CRITICAL")
        .when(high, "HIGH")
        .when((quality < 70) | (F.col("on_time_delivery_pct") < 60), "WATCH")
        .otherwise("OK")
    )
