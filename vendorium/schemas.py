"""Column names and types of every table, from the landing files to the audit tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, INT, BOOL = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
DATE, TIMESTAMP = T.DateType(), T.TimestampNTZType()
MONEY, PERCENT, TENTHS = T.DecimalType(18, 2), T.DecimalType(5, 2), T.DecimalType(5, 1)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Business columns in file order, their types, and the longest text each may hold.
BUSINESS = _struct(
    ("supplier_id", STRING),
    ("supplier_name", STRING),
    ("country_code", STRING),
    ("region", STRING),
    ("category", STRING),
    ("contract_value_usd", MONEY),
    ("lead_time_days", INT),
    ("quality_score", PERCENT),
    ("on_time_delivery_pct", PERCENT),
    ("risk_rating", STRING),
    ("last_audit_date", DATE),
    ("is_active", BOOL),
)
MAX_LENGTH = {
    "supplier_id": 50,
    "supplier_name": 255,
    "country_code": 10,
    "region": 100,
    "category": 100,
    "risk_rating": 50,
}
BUSINESS_COLUMNS = BUSINESS.names

RAW_TEXT = _struct(*[(name, STRING) for name in BUSINESS_COLUMNS])

RAW_SUPPLIERS = T.StructType(
    BUSINESS.fields
    + _struct(
        ("_source_file_name", STRING),
        ("_source_row_number", LONG),
        ("_load_ts", TIMESTAMP),
        ("_batch_id", STRING),
        ("_ingestion_status", STRING),
    ).fields
)

_LINEAGE = _struct(("source_file_name", STRING), ("source_row_number", LONG))

SUPPLIERS_CLEAN = T.StructType(
    BUSINESS.fields
    + _LINEAGE.fields
    + _struct(("load_ts", TIMESTAMP), ("record_hash", STRING)).fields
)

DIM_SUPPLIERS = T.StructType(
    _struct(("supplier_sk", LONG)).fields
    + BUSINESS.fields
    + _struct(
        ("dq_passed", BOOL),
        ("dq_fail_reasons", STRING),
        ("record_hash", STRING),
        ("valid_from", TIMESTAMP),
        ("valid_to", TIMESTAMP),
        ("is_current", BOOL),
    ).fields
    + _LINEAGE.fields
    + _struct(("load_ts", TIMESTAMP)).fields
)

REJECTED_SUPPLIERS = T.StructType(
    _struct(("reject_id", LONG)).fields
    + BUSINESS.fields
    + _struct(("rejection_reason", STRING)).fields
    + _LINEAGE.fields
    + _struct(("rejected_ts", TIMESTAMP)).fields
)

PIPELINE_RUN_LOG = _struct(
    ("run_id", LONG),
    ("task_name", STRING),
    ("procedure_name", STRING),
    ("start_time", TIMESTAMP),
    ("end_time", TIMESTAMP),
    ("rows_processed", LONG),
    ("rows_inserted", LONG),
    ("rows_updated", LONG),
    ("rows_rejected", LONG),
    ("status", STRING),
    ("error_message", STRING),
)

PIPE_LOAD_LOG = _struct(
    ("log_id", LONG),
    ("pipe_name", STRING),
    ("file_name", STRING),
    ("row_count", LONG),
    ("load_status", STRING),
    ("error_count", LONG),
    ("first_error", STRING),
    ("load_ts", TIMESTAMP),
)

DQ_SUMMARY = _struct(
    ("summary_id", LONG),
    ("check_date", DATE),
    ("total_records", LONG),
    ("passed_records", LONG),
    ("failed_records", LONG),
    ("pass_rate_pct", PERCENT),
    ("top_failure_reason", STRING),
)

AGG_RISK_SPEND = _struct(
    ("region", STRING),
    ("category", STRING),
    ("risk_rating", STRING),
    ("supplier_count", LONG),
    ("total_contract_value", MONEY),
    ("avg_quality_score", PERCENT),
    ("avg_on_time_pct", PERCENT),
    ("avg_lead_time_days", TENTHS),
    ("last_refreshed_ts", TIMESTAMP),
)

KPI_SNAPSHOT = _struct(
    ("snapshot_ts", TIMESTAMP),
    ("total_suppliers", LONG),
    ("active_suppliers", LONG),
    ("total_contract_value", MONEY),
    ("avg_quality_score", PERCENT),
    ("avg_on_time_pct", PERCENT),
    ("high_risk_count", LONG),
    ("critical_risk_count", LONG),
    ("audit_overdue_count", LONG),
    ("dq_pass_rate_pct", PERCENT),
)

# What Gold is made of: counts and exact sums by the keys of its groups and the day of the last audit.
GOLD_STATE = _struct(
    ("region", STRING),
    ("category", STRING),
    ("risk_rating", STRING),
    ("last_audit_date", DATE),
    ("suppliers", LONG),
    ("active", LONG),
    ("critical", LONG),
    ("passed", LONG),
    ("contract_value", T.DecimalType(38, 2)),
    ("quality", T.DecimalType(28, 2)),
    ("quality_known", LONG),
    ("on_time", T.DecimalType(28, 2)),
    ("on_time_known", LONG),
    ("lead_time", LONG),
    ("lead_time_known", LONG),
)


def conform(df, schema: T.StructType):
    """Select the columns of `schema` in order, cast to its types."""
    return df.select([df[field.name].cast(field.dataType).alias(field.name) for field in schema])
