"""Monitoring reads over the run log, and the load log of an ingest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vendorium.functions.scalars import count_where, percentage, seconds_between


def recent_runs(run_log: DataFrame) -> DataFrame:
    duration = seconds_between(F.col("start_time"), F.col("end_time"))
    return run_log.select(
        "run_id",
        "task_name",
        "procedure_name",
        "start_time",
        "end_time",
        duration.alias("duration_seconds"),
        "rows_processed",
        "rows_inserted",
        "rows_updated",
        "rows_rejected",
        "status",
        "error_message",
    ).orderBy(F.desc("start_time"), F.desc("run_id"))


def last_runs(run_log: DataFrame, n: int = 10) -> DataFrame:
    """The newest `n` runs; the higher run id decides between equal start times."""
    return (
        run_log.orderBy(F.desc("start_time"), F.desc("run_id"))
        .limit(n)
        .select(
            "task_name",
            "procedure_name",
            "start_time",
            "end_time",
            "rows_processed",
            "rows_inserted",
            "rows_rejected",
            "status",
        )
    )


def pipeline_health(run_log: DataFrame) -> DataFrame:
    runs, successes = F.count("*"), count_where(F.col("status") == "SUCCESS")
    duration = seconds_between(F.col("start_time"), F.col("end_time"))
    return run_log.groupBy("task_name").agg(
        runs.alias("total_runs"),
        successes.alias("success_count"),
        count_where(F.col("status") == "FAILED").alias("failure_count"),
        percentage(successes, runs).alias("success_rate_pct"),
        F.avg(duration).alias("avg_duration_seconds"),
        F.max("start_time").alias("last_run_time"),
        F.sum("rows_processed").alias("total_rows_processed"),
    )


def load_log(rows: DataFrame, pipe_name: str, load_ts: Column) -> DataFrame:
    """One row per file: data rows read, rows that failed to convert, and the first failure."""
    failed = F.col("_error").isNotNull()
    # Only numbers are aggregated, so this hashes; the text comes from the failed rows afterwards.
    counts = rows.groupBy(F.col("_source_file_name").alias("file_name")).agg(
        F.count_if(F.col("_source_row_number") > 0).alias("row_count"),
        F.count_if(failed).alias("error_count"),
        F.min(F.when(failed, F.col("_source_row_number"))).alias("row_number"),
    )
    errors = rows.filter(failed).select(
        F.col("_source_file_name").alias("file_name"),
        F.col("_source_row_number").alias("row_number"),
        F.col("_error").alias("first_error"),
    )
    per_file = counts.join(errors, ["file_name", "row_number"], "left_outer")
    status = (
        F.when(F.col("error_count") == 0, "LOADED")
        .when(F.col("error_count") < F.col("row_count"), "PARTIALLY_LOADED")
        .otherwise("LOAD_FAILED")
    )
    return per_file.select(
        F.lit(pipe_name).alias("pipe_name"),
        "file_name",
        "row_count",
        status.alias("load_status"),
        "error_count",
        "first_error",
        load_ts.alias("load_ts"),
    )
