from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from samples import GOOD, raw_rows
from vendorium.functions.quality import rules
from vendorium.operators.routing import accepted, flag, quality_summary, reason_counts, rejects

BAD = {
    "NULL_SUPPLIER_ID": {"supplier_id": None},
    "BLANK_SUPPLIER_NAME": {"supplier_name": "  "},
    "BLANK_REGION": {"region": None},
    "BLANK_COUNTRY_CODE": {"country_code": ""},
    "NULL_QUALITY_SCORE": {"quality_score": None},
    "QUALITY_SCORE_OUT_OF_RANGE": {"quality_score": Decimal("100.01")},
    "NULL_ON_TIME_DELIVERY": {"on_time_delivery_pct": None},
    "ON_TIME_DELIVERY_OUT_OF_RANGE": {"on_time_delivery_pct": Decimal("-0.01")},
    "NULL_CONTRACT_VALUE": {"contract_value_usd": None},
    "NEGATIVE_CONTRACT_VALUE": {"contract_value_usd": Decimal("-1.00")},
    "NULL_LEAD_TIME": {"lead_time_days": None},
    "NEGATIVE_LEAD_TIME": {"lead_time_days": -1},
}
NOT_CHECKED = [{"category": None}, {"risk_rating": None}, {"last_audit_date": None}, {"is_active": None}]
EDGES = [{"quality_score": Decimal("0.00")}, {"quality_score": Decimal("100.00")}, {"lead_time_days": 0}]


def test_each_rule_alone_gives_its_code(spark):
    assert [code for code, _ in rules()] == list(BAD)
    found = rejects(flag(raw_rows(spark, *BAD.values())), F.lit(None).cast("timestamp_ntz"))
    reasons = {row.source_row_number: row.rejection_reason for row in found.collect()}
    assert reasons == {number: code for number, code in enumerate(BAD, start=1)}


def test_codes_are_listed_in_order(spark):
    row = {"supplier_id": None, "region": "", "country_code": None, "lead_time_days": -5}
    found = rejects(flag(raw_rows(spark, row)), F.lit(None).cast("timestamp_ntz")).first()
    assert found.rejection_reason == "NULL_SUPPLIER_ID | BLANK_REGION | BLANK_COUNTRY_CODE | NEGATIVE_LEAD_TIME"


def test_unchecked_columns_and_edges_pass(spark):
    rows = [*NOT_CHECKED, *EDGES, {"supplier_id": " "}, {"supplier_name": "\t"}]
    assert accepted(flag(raw_rows(spark, *rows))).count() == len(rows)


def test_accepted_text_is_standard(spark):
    row = accepted(flag(raw_rows(spark, {}))).first()
    assert (row.supplier_name, row.region, row.risk_rating) == ("ACME", "EMEA", "LOW")
    assert row.source_file_name == "raw/b1.csv"


def test_hash_ignores_the_key_and_case(spark):
    rows = [{}, {"supplier_id": "S2"}, {"region": " EMEA "}, {"lead_time_days": 11}]
    hashes = [row.record_hash for row in accepted(flag(raw_rows(spark, *rows))).orderBy("source_row_number").collect()]
    assert hashes[0] == hashes[1] == hashes[2] != hashes[3]


def test_summary_takes_the_commonest_code_alphabetically(spark):
    rows = [GOOD, BAD["NULL_LEAD_TIME"], BAD["BLANK_REGION"]]
    row = quality_summary(raw_rows(spark, *rows), F.lit("2024-01-01").cast("date")).first()
    assert (row.total_records, row.passed_records, row.failed_records) == (3, 1, 2)
    assert (str(row.pass_rate_pct)[:5], row.top_failure_reason) == ("33.33", "BLANK_REGION")


def test_summary_of_nothing(spark):
    row = quality_summary(raw_rows(spark, {}).limit(0), F.lit("2024-01-01").cast("date")).first()
    assert (row.total_records, row.pass_rate_pct, row.top_failure_reason) == (0, None, None)


def test_reason_counts_leave_out_unbroken_rules(spark):
    counts = reason_counts(raw_rows(spark, {}, BAD["NULL_LEAD_TIME"], BAD["NULL_LEAD_TIME"])).collect()
    assert [tuple(row) for row in counts] == [("NULL_LEAD_TIME", 2)]
