"""Quality routing: flag each row, then split into rejects and clean candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vendorium.functions.quality import broken, dq_passed, rejection_reason, rules
from vendorium.functions.scalars import STANDARDISED, percentage, record_hash, standardise
from vendorium.schemas import BUSINESS_COLUMNS


def flag(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_dq_passed", dq_passed())


def rejects(flagged: DataFrame, rejected_ts: Column) -> DataFrame:
    return flagged.filter(~F.col("_dq_passed")).select(
        *BUSINESS_COLUMNS,
        rejection_reason().alias("rejection_reason"),
        F.col("_source_file_name").alias("source_file_name"),
        F.col("_source_row_number").alias("source_row_number"),
        rejected_ts.alias("rejected_ts"),
    )


def accepted(flagged: DataFrame, *more: str) -> DataFrame:
    """Passing rows with standard text, source columns, load time, record hash and any `more` columns."""
    columns = [
        standardise(name).alias(name) if name in STANDARDISED else F.col(name)
        for name in BUSINESS_COLUMNS
    ]
    return (
        flagged.filter("_dq_passed")
        .select(
            *columns,
            F.col("_source_file_name").alias("source_file_name"),
            F.col("_source_row_number").alias("source_row_number"),
            F.col("_load_ts").alias("load_ts"),
            *more,
        )
        .withColumn("record_hash", record_hash())
    )


def quality_summary(raw: DataFrame, check_date: Column) -> DataFrame:
    """One row: totals, pass rate and the commonest code (alphabetical on ties).

    All twelve counts come from a single partial/final aggregate, so neither the
    reasons nor the rows are exploded or shuffled.
    """
    counted = raw.agg(
        F.count("*").alias("total_records"),
        F.count_if(dq_passed()).alias("passed_records"),
        *[F.count_if(broken(condition)).alias(code) for code, condition in rules()],
    )
    ranked = F.array_sort(
        F.array(*[F.struct((-F.col(code)).alias("rank"), F.lit(code).alias("code")) for code, _ in rules()])
    )
    top = ranked.getItem(0)
    return counted.select(
        check_date.alias("check_date"),
        "total_records",
        "passed_records",
        (F.col("total_records") - F.col("passed_records")).alias("failed_records"),
        percentage(F.col("passed_records"), F.col("total_records")).alias("pass_rate_pct"),
        F.when(top["rank"] < 0, top["code"]).alias("top_failure_reason"),
    )


def reason_counts(raw: DataFrame) -> DataFrame:
    """How many rows broke each rule, one row per code that occurs."""
    counted = raw.agg(*[F.count_if(broken(condition)).alias(code) for code, condition in rules()])
    return counted.select(
        F.inline(F.array(*[F.struct(F.lit(code).alias("code"), F.col(code).alias("records")) for code, _ in rules()]))
    ).filter("records > 0")
