"""Independent ANSI SQL for every registered query, to be run by another engine on the same tables.

The statements share a chain of common table expressions, feed -> checked -> accepted ->
deliveries -> versions -> clean, and then state each result in the most direct way (plain
windows, integer averages), not in the way the Spark jobs compute it.
"""

from __future__ import annotations

AS_OF = "1999-06-30"  # fixed values: the clock of all registered queries
RUN_TS = "2024-01-01 00:30:00"

_FEED = """
lines AS (
  SELECT *, l_orderkey * 31 + l_partkey * 17 + l_suppkey * 7 + l_linenumber AS h, l_orderkey % 4 + 1 AS bn
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
), sent AS (
  SELECT *, bn AS batch_no FROM lines
  UNION ALL
  SELECT *, 5 AS batch_no FROM lines WHERE bn = 4 AND h % 101 <> 0 AND l_suppkey % 3 = 0
), feed AS (
  SELECT
    CASE WHEN h % 101 = 0 THEN NULL
         ELSE 'SUP-' || lpad(CAST(l_suppkey AS VARCHAR), greatest(6, length(CAST(l_suppkey AS VARCHAR)))::INT, '0')
              || '-' || lpad(CAST(l_partkey % 20 AS VARCHAR), 2, '0') END AS supplier_id,
    CASE WHEN h % 103 = 0 THEN '  ' WHEN h % 107 = 0 THEN NULL
         ELSE ' ' || lower(s_name) || ' ' END AS supplier_name,
    CASE WHEN h % 109 = 0 THEN NULL ELSE lower(n_name) END AS country_code,
    CASE WHEN h % 113 = 0 THEN '' ELSE lower(r_name) END AS region,
    lower(p_type) AS category,
    CASE WHEN h % 127 = 0 THEN NULL WHEN h % 131 = 0 THEN -CAST(l_extendedprice AS DECIMAL(18,2))
         ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS contract_value_usd,
    CASE WHEN h % 137 = 0 THEN NULL WHEN h % 139 = 0 THEN -1
         ELSE CAST(l_quantity AS INTEGER) END AS lead_time_days,
    CAST(CASE WHEN h % 149 = 0 THEN NULL WHEN h % 151 = 0 THEN 100.01 WHEN h % 157 = 0 THEN -0.01
         ELSE CAST(h % 10001 AS DECIMAL(10,2)) / 100 END AS DECIMAL(5,2)) AS quality_score,
    CAST(CASE WHEN h % 179 = 0 THEN NULL WHEN h % 181 = 0 THEN 100.01
         ELSE CAST(h * 13 % 10001 AS DECIMAL(10,2)) / 100 END AS DECIMAL(5,2)) AS on_time_delivery_pct,
    CASE WHEN h % 163 = 0 THEN NULL WHEN h % 10 < 2 THEN 'high' WHEN h % 10 < 5 THEN 'Medium'
         ELSE ' low ' END AS risk_rating,
    CASE WHEN h % 167 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS last_audit_date,
    CASE WHEN h % 173 = 0 THEN NULL ELSE l_linestatus = 'O' END AS is_active,
    'raw/suppliers_batch_00' || batch_no || '.csv' AS _source_file_name,
    l_orderkey * 8 + l_linenumber AS _source_row_number,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(batch_no * 5 AS INT)) AS _load_ts,
    'suppliers_batch_00' || batch_no AS _batch_id,
    'LOADED' AS _ingestion_status,
    batch_no, h
  FROM sent
)"""

# Rule codes and conditions, in reason order.
_RULES = [
    ("NULL_SUPPLIER_ID", "supplier_id IS NULL"),
    ("BLANK_SUPPLIER_NAME", "supplier_name IS NULL OR trim(supplier_name) = ''"),
    ("BLANK_REGION", "region IS NULL OR trim(region) = ''"),
    ("BLANK_COUNTRY_CODE", "country_code IS NULL OR trim(country_code) = ''"),
    ("NULL_QUALITY_SCORE", "quality_score IS NULL"),
    ("QUALITY_SCORE_OUT_OF_RANGE", "quality_score NOT BETWEEN 0 AND 100"),
    ("NULL_ON_TIME_DELIVERY", "on_time_delivery_pct IS NULL"),
    ("ON_TIME_DELIVERY_OUT_OF_RANGE", "on_time_delivery_pct NOT BETWEEN 0 AND 100"),
    ("NULL_CONTRACT_VALUE", "contract_value_usd IS NULL"),
    ("NEGATIVE_CONTRACT_VALUE", "contract_value_usd < 0"),
    ("NULL_LEAD_TIME", "lead_time_days IS NULL"),
    ("NEGATIVE_LEAD_TIME", "lead_time_days < 0"),
]

_REASON = "trim(" + " || ".join(f"CASE WHEN {c} THEN '{code} | ' ELSE '' END" for code, c in _RULES) + ", '| ')"


def _checked(source: str = "feed") -> str:
    return f", checked AS (SELECT *, {_REASON} AS rejection_reason FROM {source})"


_HASH = "md5(" + " || '|' || ".join(
    f"coalesce(CAST({name} AS VARCHAR), '')"
    for name in (
        "supplier_name country_code region category contract_value_usd lead_time_days quality_score "
        "on_time_delivery_pct risk_rating last_audit_date is_active"
    ).split()
) + ")"

_ACCEPTED = f"""
, accepted AS (
  SELECT *, {_HASH} AS record_hash FROM (
    SELECT supplier_id, trim(upper(supplier_name)) AS supplier_name, trim(upper(country_code)) AS country_code,
      trim(upper(region)) AS region, trim(upper(category)) AS category, contract_value_usd, lead_time_days,
      quality_score, on_time_delivery_pct, trim(upper(risk_rating)) AS risk_rating, last_audit_date, is_active,
      _source_file_name AS source_file_name, _source_row_number AS source_row_number, _load_ts AS load_ts
    FROM checked WHERE rejection_reason = '')
)"""

_DELIVERIES = """
, deliveries AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY supplier_id, load_ts
      ORDER BY source_file_name DESC, source_row_number DESC, record_hash DESC) AS rn
    FROM accepted) WHERE rn = 1
)"""

_VERSIONS = """
, steps AS (
  SELECT *, lag(record_hash) OVER (PARTITION BY supplier_id ORDER BY load_ts) AS before FROM deliveries
), versions AS (
  SELECT * EXCLUDE (before), load_ts AS valid_from, TRUE AS dq_passed, CAST(NULL AS VARCHAR) AS dq_fail_reasons,
    lead(load_ts) OVER (PARTITION BY supplier_id ORDER BY load_ts) AS valid_to,
    lead(load_ts) OVER (PARTITION BY supplier_id ORDER BY load_ts) IS NULL AS is_current
  FROM steps WHERE before IS NULL OR before <> record_hash
), clean AS (SELECT * FROM versions WHERE is_current)"""

TO_CHECKED = "WITH " + _FEED + _checked()
TO_ACCEPTED = TO_CHECKED + _ACCEPTED
TO_DELIVERIES = TO_ACCEPTED + _DELIVERIES
TO_CLEAN = TO_DELIVERIES + _VERSIONS

_TEXT_COLUMNS = (
    "supplier_id supplier_name country_code region category contract_value_usd lead_time_days quality_score "
    "on_time_delivery_pct risk_rating last_audit_date is_active"
).split()
_LINE_KEY = "md5(concat_ws('|', " + ", ".join(f"coalesce({name}, '')" for name in _TEXT_COLUMNS) + "))"

# The feed as lines of text, then as the values that those lines must load as. `k` decides both.
_LANDED = f"""
, texts AS (
  SELECT batch_no, _source_row_number AS k, _load_ts,
    CASE WHEN _source_row_number % 233 = 0 THEN rpad(supplier_id, 60, 'X') ELSE supplier_id END AS supplier_id,
    CASE WHEN _source_row_number % 227 = 0 THEN 'acme, "north" ltd'
         WHEN _source_row_number % 239 = 0 AND batch_no = 3 THEN 'two' || chr(10) || 'lines'
         ELSE supplier_name END AS supplier_name,
    country_code, region,
    CASE WHEN _source_row_number % 229 = 0 THEN 'NULL' ELSE category END AS category,
    CASE WHEN _source_row_number % 191 = 0 THEN '12.34.5'
         ELSE CAST(contract_value_usd AS VARCHAR) END AS contract_value_usd,
    CASE WHEN _source_row_number % 211 = 0 THEN '10.7' ELSE CAST(lead_time_days AS VARCHAR) END AS lead_time_days,
    CASE WHEN _source_row_number % 193 = 0 THEN 'n/a'
         WHEN _source_row_number % 223 = 0 THEN '58.739999999999995'
         WHEN _source_row_number % 241 = 0 THEN '1000'
         ELSE CAST(quality_score AS VARCHAR) END AS quality_score,
    CAST(on_time_delivery_pct AS VARCHAR) AS on_time_delivery_pct, risk_rating,
    CASE WHEN _source_row_number % 197 = 0 THEN '2022'
         ELSE CAST(last_audit_date AS VARCHAR) END AS last_audit_date,
    CASE WHEN _source_row_number % 199 = 0 THEN 'maybe' WHEN is_active THEN 'True'
         WHEN NOT is_active THEN 'False' END AS is_active
  FROM feed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY batch_no ORDER BY k, {_LINE_KEY}) AS position,
    CASE WHEN length(supplier_id) > 50 THEN 'supplier_id: too long: ' || supplier_id
         WHEN k % 191 = 0 THEN 'contract_value_usd: cannot convert: 12.34.5'
         WHEN quality_score IN ('n/a', '1000') THEN 'quality_score: cannot convert: ' || quality_score
         WHEN k % 197 = 0 THEN 'last_audit_date: cannot convert: 2022'
         WHEN k % 199 = 0 THEN 'is_active: cannot convert: maybe' END AS error
  FROM texts
), loaded AS (
  SELECT supplier_id, nullif(trim(supplier_name), '') AS supplier_name, country_code,
    nullif(region, '') AS region, nullif(category, 'NULL') AS category,
    CAST(contract_value_usd AS DECIMAL(18,2)) AS contract_value_usd,
    CAST(CASE WHEN k % 211 = 0 THEN '11' ELSE lead_time_days END AS INTEGER) AS lead_time_days,
    CAST(CASE WHEN quality_score = '58.739999999999995' THEN '58.74' ELSE quality_score END AS DECIMAL(5,2))
      AS quality_score,
    CAST(on_time_delivery_pct AS DECIMAL(5,2)) AS on_time_delivery_pct, trim(risk_rating) AS risk_rating,
    CAST(last_audit_date AS DATE) AS last_audit_date, CAST(lower(is_active) AS BOOLEAN) AS is_active,
    'batch_' || batch_no AS batch, 'batch_' || batch_no AS _source_file_name, position AS _source_row_number,
    _load_ts, batch_no, 'LOADED' AS _ingestion_status
  FROM placed WHERE error IS NULL
)"""
TO_LOADED = "WITH " + _FEED + _LANDED
TO_STREAMED = TO_LOADED + _checked("loaded") + _ACCEPTED + _DELIVERIES + _VERSIONS

_RUNS = """
WITH runs AS (
  SELECT event_id AS run_id,
    CASE WHEN event_id % 2 = 0 THEN 'TASK_BRONZE_TO_SILVER' ELSE 'TASK_SILVER_TO_GOLD' END AS task_name,
    CASE WHEN event_id % 2 = 0 THEN 'SP_BRONZE_TO_SILVER' ELSE 'SP_SILVER_TO_GOLD' END AS procedure_name,
    ts AS start_time,
    ts + to_microseconds(CAST(CAST(value AS DECIMAL(18,6)) * 1000000 AS BIGINT)) AS end_time,
    event_id * 37 % 1000 AS rows_processed, event_id % 7 AS rows_inserted,
    event_id % 5 AS rows_updated, event_id % 3 AS rows_rejected,
    CASE WHEN event_id % 11 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN event_id % 11 = 0 THEN 'error ' || event_id END AS error_message
  FROM events
)"""

_CAST = {"i": "BIGINT", "f": "DOUBLE", "s": "VARCHAR"}


def _out(columns: str, tail: str) -> str:
    """Final SELECT; `columns` lists name:kind with i = integer, f = number, s = text, date, time or flag."""
    names = [spec.split(":") for spec in columns.split()]
    return "\nSELECT " + ", ".join(f"CAST({n} AS {_CAST[k]}) AS {n}" for n, k in names) + f"\nFROM {tail}"


def _avg(column: str, digits: int = 2) -> str:
    """Exact half-up average of a non-negative column, in integers."""
    unit = 10**digits
    total = f"SUM(CAST({column} * {unit} AS HUGEINT))"
    return f"((2 * {total} + COUNT({column})) // (2 * COUNT({column}))) / {unit}.0"


def _pct(part: str, whole: str) -> str:
    return f"((2 * 10000 * CAST({part} AS HUGEINT) + {whole}) // (2 * NULLIF({whole}, 0))) / 100.0"


def _avg1(column: str) -> str:
    """Half up to one digit from a column with two decimals."""
    total = f"SUM(CAST({column} * 100 AS HUGEINT))"
    return f"((2 * {total} + 10 * COUNT({column})) // (20 * COUNT({column}))) / 10.0"


_BUS = (
    "supplier_id:s supplier_name:s country_code:s region:s category:s contract_value_usd:f lead_time_days:i "
    "quality_score:f on_time_delivery_pct:f risk_rating:s last_audit_date:s is_active:s "
)
_CLEAN_COLUMNS = _BUS + "source_file_name:s source_row_number:i load_ts:s record_hash:s"
_DIM_COLUMNS = (
    _BUS + "dq_passed:s dq_fail_reasons:s record_hash:s valid_from:s valid_to:s is_current:s "
    "source_file_name:s source_row_number:i load_ts:s"
)
_MONEY = "COUNT(*) AS supplier_count, SUM(contract_value_usd) AS total_contract_value"
_AVERAGES = (
    f"{_avg('quality_score')} AS avg_quality_score, {_avg('on_time_delivery_pct')} AS avg_on_time_delivery_pct, "
    f"{_avg('lead_time_days', 1)} AS avg_lead_time_days"
)
_HIGH = "SUM(CASE WHEN risk_rating = 'HIGH' THEN 1 ELSE 0 END) AS high_risk_count"
_SUMMARY = "supplier_count:i total_contract_value:f "
_SUMMARY_TAIL = "avg_quality_score:f avg_on_time_delivery_pct:f avg_lead_time_days:f high_risk_count:i"

_REGIONAL = f"""
, regional AS (
  SELECT region, {_MONEY}, {_avg('contract_value_usd')} AS avg_contract_value, {_AVERAGES}, {_HIGH},
    SUM(CASE WHEN risk_rating = 'MEDIUM' THEN 1 ELSE 0 END) AS medium_risk_count,
    SUM(CASE WHEN risk_rating = 'LOW' THEN 1 ELSE 0 END) AS low_risk_count,
    SUM(CASE WHEN is_active = TRUE THEN 1 ELSE 0 END) AS active_suppliers
  FROM clean GROUP BY region)"""
_CATEGORY = f"""
, categories AS (
  SELECT category, {_MONEY}, {_avg('contract_value_usd')} AS avg_contract_value, {_AVERAGES}, {_HIGH}
  FROM clean GROUP BY category)"""
_RISK = f"""
, risk AS (
  SELECT *,
    CASE WHEN risk_rating = 'HIGH' AND quality_score < 75 THEN 'CRITICAL'
         WHEN risk_rating = 'HIGH' THEN 'HIGH'
         WHEN quality_score < 70 OR on_time_delivery_pct < 60 THEN 'WATCH'
         ELSE 'OK' END AS risk_level,
    date_diff('day', last_audit_date, DATE '{AS_OF}') AS days_since_audit,
    CASE WHEN date_diff('day', last_audit_date, DATE '{AS_OF}') > 365 THEN TRUE ELSE FALSE END AS audit_overdue
  FROM clean WHERE risk_rating = 'HIGH' OR quality_score < 75 OR on_time_delivery_pct < 60)"""
_RANKS = """
, scored AS (
  SELECT *, quality_score * 0.4 + on_time_delivery_pct * 0.4
    + (1 - CAST(lead_time_days / 30.0 AS DECIMAL(9,6))) * 100 * 0.2 AS score FROM clean
), ranked AS (
  SELECT *, rank() OVER (PARTITION BY region ORDER BY score DESC) AS rank_in_region,
    rank() OVER (ORDER BY score DESC) AS overall_rank, count(*) OVER () AS n FROM scored
), rankings AS (
  SELECT * REPLACE (round(score, 2) AS score), score AS exact_score,
    CASE WHEN overall_rank <= ceil(n * 0.2) THEN 'TIER_1_TOP'
         WHEN overall_rank >= ceil(n * 0.8) THEN 'TIER_3_BOTTOM'
         ELSE 'TIER_2_MID' END AS performance_tier,
    round(score, 2) AS performance_score
  FROM ranked
), top20 AS (SELECT * FROM rankings ORDER BY overall_rank, supplier_id LIMIT 20)"""


def statements() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["dq_flag_counts"] = TO_CHECKED + _out(
        "batch_no:i dq_passed:s records:i",
        "(SELECT batch_no, rejection_reason = '' AS dq_passed, COUNT(*) AS records FROM checked GROUP BY 1, 2)",
    )
    sql["rejected_rows"] = TO_CHECKED + _out(
        _BUS + "rejection_reason:s source_file_name:s source_row_number:i rejected_ts:s",
        "(SELECT *, _source_file_name AS source_file_name, _source_row_number AS source_row_number, "
        "_load_ts AS rejected_ts FROM checked WHERE rejection_reason <> '')",
    )
    sql["rejection_reasons"] = TO_CHECKED + _out(
        "rejection_reason:s records:i",
        "(SELECT rejection_reason, COUNT(*) AS records FROM checked WHERE rejection_reason <> '' GROUP BY 1)",
    )
    codes = " UNION ALL ".join(
        f"SELECT '{code}' AS code, COUNT(*) AS records FROM feed WHERE {condition}" for code, condition in _RULES
    )
    sql["rule_failures"] = TO_CHECKED + _out("code:s records:i", f"({codes}) WHERE records > 0")
    sql["dq_summary"] = TO_CHECKED + _out(
        "check_date:s total_records:i passed_records:i failed_records:i pass_rate_pct:f top_failure_reason:s",
        f"""(SELECT DATE '{AS_OF}' AS check_date, COUNT(*) AS total_records,
          SUM(CASE WHEN rejection_reason = '' THEN 1 ELSE 0 END) AS passed_records,
          SUM(CASE WHEN rejection_reason = '' THEN 0 ELSE 1 END) AS failed_records,
          {_pct("SUM(CASE WHEN rejection_reason = '' THEN 1 ELSE 0 END)", "COUNT(*)")} AS pass_rate_pct,
          (SELECT code FROM (SELECT unnest(string_split(rejection_reason, ' | ')) AS code FROM checked
             WHERE rejection_reason <> '') GROUP BY code ORDER BY COUNT(*) DESC, code LIMIT 1) AS top_failure_reason
        FROM checked)""",
    )
    sql["standardised_clean"] = TO_ACCEPTED + _out(
        "supplier_id:s supplier_name:s country_code:s region:s category:s risk_rating:s "
        "source_file_name:s source_row_number:i",
        "accepted",
    )
    sql["record_hash"] = TO_ACCEPTED + _out(
        "supplier_id:s source_file_name:s source_row_number:i record_hash:s", "accepted"
    )
    sql["latest_per_batch"] = TO_DELIVERIES + _out(_CLEAN_COLUMNS, "deliveries")
    sql["upsert_clean_state"] = TO_CLEAN + _out(_CLEAN_COLUMNS, "clean")
    sql["clean_state"] = sql["upsert_clean_state"]
    sql["scd2_fold"] = sql["scd2_rebuild"] = TO_CLEAN + _out(_DIM_COLUMNS, "versions")
    sql["scd2_expired_by_batch"] = TO_CLEAN + _out(
        "load_ts:s expired:i",
        "(SELECT valid_to AS load_ts, COUNT(*) AS expired FROM versions WHERE valid_to IS NOT NULL GROUP BY 1)",
    )
    sql["new_versions_by_batch"] = TO_CLEAN + _out(
        "load_ts:s opened:i", "(SELECT valid_from AS load_ts, COUNT(*) AS opened FROM versions GROUP BY 1)"
    )
    sql["version_counts"] = TO_CLEAN + _out(
        "is_current:s versions:i", "(SELECT is_current, COUNT(*) AS versions FROM versions GROUP BY 1)"
    )
    sql["duplicate_keys"] = TO_CLEAN + _out(
        "delivery_duplicates:i clean_duplicates:i",
        "(SELECT (SELECT COUNT(*) FROM (SELECT supplier_id FROM deliveries GROUP BY 1 HAVING COUNT(*) > 1)) "
        "AS delivery_duplicates, (SELECT COUNT(*) FROM clean) - (SELECT COUNT(DISTINCT supplier_id) FROM clean) "
        "AS clean_duplicates)",
    )
    # Current state by each supplier's last delivery, open versions by where the hash last changed.
    sql["reconcile"] = TO_CLEAN + _out(
        "disagreeing:i",
        """(SELECT COUNT(*) AS disagreeing
        FROM (SELECT supplier_id, arg_max(record_hash, load_ts) AS state_hash FROM deliveries GROUP BY 1) d
        FULL JOIN (SELECT supplier_id, record_hash AS open_hash FROM versions WHERE is_current) v USING (supplier_id)
        WHERE state_hash IS DISTINCT FROM open_hash)""",
    )
    sql["surrogate_keys"] = TO_CLEAN + _out(
        "supplier_sk:i supplier_id:s valid_from:s",
        "(SELECT row_number() OVER (ORDER BY supplier_id, valid_from) AS supplier_sk, * FROM versions)",
    )
    sql["raw_latest"] = "WITH " + _FEED + _out(
        _BUS + "_source_file_name:s _source_row_number:i _load_ts:s _batch_id:s _ingestion_status:s",
        "feed ORDER BY feed._load_ts DESC, feed._source_file_name, feed._source_row_number",
    )

    sql["regional_summary"] = TO_CLEAN + _REGIONAL + _out(
        "region:s " + _SUMMARY + "avg_contract_value:f " + _SUMMARY_TAIL
        + " medium_risk_count:i low_risk_count:i active_suppliers:i",
        "regional",
    )
    sql["dashboard_regional"] = TO_CLEAN + _REGIONAL + _out(
        "region:s supplier_count:i avg_quality_score:f", "regional"
    )
    sql["category_summary"] = TO_CLEAN + _CATEGORY + _out(
        "category:s " + _SUMMARY + "avg_contract_value:f " + _SUMMARY_TAIL, "categories"
    )
    sql["dashboard_category"] = TO_CLEAN + _CATEGORY + _out(
        "category:s total_contract_value:f avg_on_time_delivery_pct:f", "categories"
    )
    sql["monthly_trends"] = TO_CLEAN + _out(
        "audit_month:s region:s " + _SUMMARY + _SUMMARY_TAIL,
        f"(SELECT CAST(date_trunc('month', last_audit_date) AS DATE) AS audit_month, region, {_MONEY}, "
        f"{_AVERAGES}, {_HIGH} FROM clean GROUP BY 1, 2) ORDER BY 1, 2",
    )
    averages = _AVERAGES.replace("AS avg_on_time_delivery_pct", "AS avg_on_time_pct")
    sql["agg_risk_spend"] = TO_CLEAN + _out(
        "region:s category:s risk_rating:s " + _SUMMARY
        + "avg_quality_score:f avg_on_time_pct:f avg_lead_time_days:f last_refreshed_ts:s",
        f"(SELECT region, category, risk_rating, {_MONEY}, {averages}, TIMESTAMP '{RUN_TS}' AS last_refreshed_ts "
        "FROM clean GROUP BY 1, 2, 3)",
    )
    passed = "SUM(CASE WHEN dq_passed = TRUE THEN 1 ELSE 0 END)"
    sql["dq_pass_rate"] = TO_CLEAN + _out(
        "dq_pass_rate_pct:f", f"(SELECT {_pct(passed, 'COUNT(*)')} AS dq_pass_rate_pct FROM clean)"
    )
    sql["kpi_snapshot"] = TO_CLEAN + _out(
        "snapshot_ts:s total_suppliers:i active_suppliers:i total_contract_value:f avg_quality_score:f "
        "avg_on_time_pct:f high_risk_count:i critical_risk_count:i audit_overdue_count:i dq_pass_rate_pct:f",
        f"""(SELECT TIMESTAMP '{RUN_TS}' AS snapshot_ts, COUNT(*) AS total_suppliers,
          SUM(CASE WHEN is_active = TRUE THEN 1 ELSE 0 END) AS active_suppliers,
          SUM(contract_value_usd) AS total_contract_value,
          {_avg('quality_score')} AS avg_quality_score, {_avg('on_time_delivery_pct')} AS avg_on_time_pct, {_HIGH},
          SUM(CASE WHEN risk_rating = 'HIGH' AND quality_score < 75 THEN 1 ELSE 0 END) AS critical_risk_count,
          SUM(CASE WHEN date_diff('day', last_audit_date, DATE '{AS_OF}') > 365 THEN 1 ELSE 0 END)
            AS audit_overdue_count,
          (SELECT {_pct(passed, 'COUNT(*)')} FROM versions WHERE is_current) AS dq_pass_rate_pct
        FROM clean)""",
    )
    sql["kpi_dashboard"] = TO_CLEAN + _out(
        "total_suppliers:i active_suppliers:i total_contract_value:f avg_quality_score:f avg_on_time_pct:f "
        "high_risk_count:i",
        f"""(SELECT COUNT(*) AS total_suppliers, SUM(CASE WHEN is_active = TRUE THEN 1 ELSE 0 END) AS active_suppliers,
          round(SUM(contract_value_usd), 0) AS total_contract_value, {_avg1('quality_score')} AS avg_quality_score,
          {_avg1('on_time_delivery_pct')} AS avg_on_time_pct, {_HIGH} FROM clean)""",
    )
    sql["risk_scorecard"] = TO_CLEAN + _RISK + _out(
        "supplier_id:s supplier_name:s region:s category:s country_code:s contract_value_usd:f quality_score:f "
        "on_time_delivery_pct:f lead_time_days:i risk_rating:s last_audit_date:s risk_level:s days_since_audit:i "
        "audit_overdue:s",
        "risk",
    )
    sql["risk_list"] = TO_CLEAN + _RISK + _out(
        "supplier_id:s supplier_name:s region:s category:s quality_score:f on_time_delivery_pct:f risk_rating:s "
        "risk_level:s days_since_audit:i audit_overdue:s",
        "risk WHERE risk_level IN ('CRITICAL', 'WATCH', 'OK') ORDER BY risk.risk_level DESC, risk.quality_score",
    )
    sql["risk_levels"] = TO_CLEAN + _RISK + _out("risk_level:s", "(SELECT DISTINCT risk_level FROM risk)")
    sql["supplier_rankings"] = TO_CLEAN + _RANKS + _out(
        "supplier_id:s supplier_name:s region:s category:s country_code:s contract_value_usd:f quality_score:f "
        "on_time_delivery_pct:f lead_time_days:i risk_rating:s performance_score:f rank_in_region:i overall_rank:i "
        "performance_tier:s",
        "rankings",
    )
    sql["top20_suppliers"] = TO_CLEAN + _RANKS + _out(
        "supplier_name:s region:s category:s performance_score:f overall_rank:i rank_in_region:i performance_tier:s",
        "top20",
    )
    sql["tier_distribution"] = TO_CLEAN + _RANKS + _out(
        "performance_tier:s suppliers:i",
        "(SELECT performance_tier, COUNT(*) AS suppliers FROM top20 GROUP BY 1)",
    )

    run_columns = (
        "task_name:s procedure_name:s start_time:s end_time:s {0}rows_processed:i rows_inserted:i {1}"
        "rows_rejected:i status:s"
    )
    sql["recent_runs"] = _RUNS + _out(
        "run_id:i " + run_columns.format("duration_seconds:i ", "rows_updated:i ") + " error_message:s",
        "(SELECT *, date_diff('second', start_time, end_time) AS duration_seconds FROM runs) ORDER BY 4 DESC",
    )
    sql["last10_runs"] = _RUNS + _out(
        run_columns.format("", ""), "(SELECT * FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 10)"
    )
    success = "SUM(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END)"
    sql["pipeline_health"] = _RUNS + _out(
        "task_name:s total_runs:i success_count:i failure_count:i success_rate_pct:f avg_duration_seconds:f "
        "last_run_time:s total_rows_processed:i",
        f"""(SELECT task_name, COUNT(*) AS total_runs, {success} AS success_count,
          SUM(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS failure_count,
          {_pct(success, 'COUNT(*)')} AS success_rate_pct,
          AVG(date_diff('second', start_time, end_time)) AS avg_duration_seconds,
          MAX(start_time) AS last_run_time, SUM(rows_processed) AS total_rows_processed
        FROM runs GROUP BY task_name)""",
    )

    sql["predicates"] = "WITH " + _FEED + _out(
        "_source_file_name:s _source_row_number:i category:s blank_name:s blank_region:s blank_country:s "
        "quality_outside:s on_time_outside:s negative_value:s negative_lead:s watched:s grade:s source:s",
        """(SELECT *, supplier_name IS NULL OR trim(supplier_name) = '' AS blank_name,
          region IS NULL OR trim(region) = '' AS blank_region,
          country_code IS NULL OR trim(country_code) = '' AS blank_country,
          quality_score NOT BETWEEN 0 AND 100 AS quality_outside,
          on_time_delivery_pct NOT BETWEEN 0 AND 100 AS on_time_outside,
          contract_value_usd < 0 AS negative_value, lead_time_days < 0 AS negative_lead,
          risk_rating <> 'high' AND quality_score < 75 OR is_active = TRUE AS watched,
          CASE WHEN quality_score < 70 THEN 'LOW' WHEN quality_score < 90 THEN 'MID'
            WHEN quality_score IS NULL THEN 'NONE' ELSE 'TOP' END AS grade,
          'feed' AS source FROM feed)""",
    )
    sql["conditional_counts"] = "WITH " + _FEED + _out(
        "category:s deliveries:i high:i inactive:i unaudited:i",
        """(SELECT category, COUNT(*) AS deliveries, SUM(CASE WHEN risk_rating = 'high' THEN 1 ELSE 0 END) AS high,
          SUM(CASE WHEN is_active = FALSE THEN 1 ELSE 0 END) AS inactive,
          SUM(CASE WHEN last_audit_date IS NULL THEN 1 ELSE 0 END) AS unaudited FROM feed GROUP BY 1)""",
    )
    sql["text_functions"] = "WITH " + _FEED + _out(
        "_source_file_name:s _source_row_number:i category:s trimmed:s bars_trimmed:s uppered:s joined:s filled:s "
        "value_text:s score_text:s stem:s",
        """(SELECT *, trim(supplier_name) AS trimmed, trim('| ' || country_code || ' | ', '| ') AS bars_trimmed,
          upper(risk_rating) AS uppered, supplier_id || '|' || country_code AS joined,
          coalesce(supplier_id, '') AS filled, CAST(contract_value_usd AS VARCHAR) AS value_text,
          CAST(quality_score AS VARCHAR) AS score_text,
          split_part(split_part(_source_file_name, '/', -1), '.', 1) AS stem FROM feed)""",
    )
    sql["numeric_functions"] = "WITH " + _FEED + _out(
        "_source_file_name:s _source_row_number:i category:s rounded:f score_up:i lead_or_null:i total:f "
        "gap:f weighted:f lead_share:f",
        """(SELECT *, round(quality_score, 1) AS rounded, ceil(quality_score) AS score_up,
          nullif(lead_time_days, 10) AS lead_or_null, quality_score + on_time_delivery_pct AS total,
          quality_score - on_time_delivery_pct AS gap, quality_score * 0.4 AS weighted,
          CAST(lead_time_days / 30.0 AS DECIMAL(17,6)) AS lead_share FROM feed)""",
    )
    sql["date_functions"] = _RUNS + _out(
        "run_id:i days_since:i month_start:s seconds:i stamped:s as_of:s",
        f"""(SELECT *, date_diff('day', CAST(start_time AS DATE), DATE '{AS_OF}') AS days_since,
          CAST(date_trunc('month', start_time) AS DATE) AS month_start,
          date_diff('second', start_time, end_time) AS seconds,
          TIMESTAMP '{RUN_TS}' AS stamped, DATE '{AS_OF}' AS as_of FROM runs)""",
    )

    sql["csv_ingest"] = TO_LOADED + _out(_BUS + "batch:s _ingestion_status:s", "loaded")
    sql["csv_row_numbers"] = TO_LOADED + _out(
        "batch:s lines:i numbers:i last_number:i stems:i",
        """(SELECT 'batch_' || batch_no AS batch, COUNT(*) AS lines, COUNT(*) AS numbers, COUNT(*) AS last_number,
          COUNT(*) AS stems FROM placed GROUP BY batch_no)""",
    )
    sql["load_log"] = TO_LOADED + _out(
        "batch:s pipe_name:s row_count:i error_count:i first_error:s failed_files:i",
        """(SELECT 'batch_' || batch_no AS batch, 'PIPE_RAW_SUPPLIERS' AS pipe_name, COUNT(*) AS row_count,
          COUNT(error) AS error_count, arg_min(error, position) FILTER (error IS NOT NULL) AS first_error,
          0 AS failed_files FROM placed GROUP BY batch_no)""",
    )
    stream_dim = _DIM_COLUMNS.replace("source_file_name:s source_row_number:i ", "")
    sql["stream_dimension"] = TO_STREAMED + _out(
        "supplier_sk:i " + stream_dim,
        "(SELECT *, row_number() OVER (ORDER BY valid_from, supplier_id) AS supplier_sk FROM versions)",
    )
    sql["stream_clean"] = TO_STREAMED + _out(
        _CLEAN_COLUMNS.replace("source_file_name:s source_row_number:i ", ""), "clean"
    )
    sql["stream_rejected"] = TO_STREAMED + _out(
        _BUS + "rejection_reason:s rejected_ts:s",
        "(SELECT *, _load_ts AS rejected_ts FROM checked WHERE rejection_reason <> '')",
    )
    groups = (
        "(SELECT COUNT(*) FROM (SELECT DISTINCT region, category, risk_rating FROM versions v "
        "WHERE v.valid_from <= t._load_ts AND (v.valid_to IS NULL OR v.valid_to > t._load_ts)))"
    )
    sql["stream_run_log"] = TO_STREAMED + _out(
        "run_id:i task_name:s procedure_name:s start_time:s rows_processed:i rows_inserted:i rows_updated:i "
        "rows_rejected:i status:s error_message:s",
        f"""(SELECT 2 * batch_no - 1 AS run_id, 'TASK_BRONZE_TO_SILVER' AS task_name,
          'SP_BRONZE_TO_SILVER' AS procedure_name, _load_ts AS start_time, opened + refused AS rows_processed,
          opened AS rows_inserted, closed AS rows_updated, refused AS rows_rejected, 'SUCCESS' AS status,
          NULL AS error_message
        FROM (SELECT batch_no, _load_ts,
            (SELECT COUNT(*) FROM versions v WHERE v.valid_from = t._load_ts) AS opened,
            (SELECT COUNT(*) FROM versions v WHERE v.valid_to = t._load_ts) AS closed,
            (SELECT COUNT(*) FROM checked c WHERE c._load_ts = t._load_ts AND c.rejection_reason <> '') AS refused
          FROM (SELECT DISTINCT batch_no, _load_ts FROM feed) t)
        UNION ALL
        SELECT 2 * batch_no, 'TASK_SILVER_TO_GOLD', 'SP_SILVER_TO_GOLD', _load_ts, {groups} + 1, {groups} + 1, 0, 0,
          'SUCCESS', NULL
        FROM (SELECT DISTINCT batch_no, _load_ts FROM feed) t)""",
    )
    sql["stream_kpi"] = (
        sql["kpi_snapshot"]
        .replace(TO_CLEAN, TO_STREAMED)
        .replace(f"TIMESTAMP '{RUN_TS}'", "TIMESTAMP '2024-01-01 00:25:00'")
        .replace(f"DATE '{AS_OF}'", "DATE '2024-01-01'")
    )
    sql["stream_folded"] = sql["stream_dimension"]
    sql["stream_agg_risk_spend"] = (
        sql["agg_risk_spend"].replace(TO_CLEAN, TO_STREAMED).replace(f"TIMESTAMP '{RUN_TS}'", "TIMESTAMP '2024-01-01 00:25:00'")
    )
    sql["stream_raw"] = TO_STREAMED + _out(_BUS + "batch:s _load_ts:s _ingestion_status:s", "loaded")
    sql["stream_load_log"] = TO_STREAMED + _out(
        "batch:s pipe_name:s load_ts:s row_count:i error_count:i unexplained:i misnamed:i gaps:i",
        """(SELECT 'batch_' || batch_no AS batch, 'PIPE_RAW_SUPPLIERS' AS pipe_name, _load_ts AS load_ts, COUNT(*) AS row_count,
          COUNT(error) AS error_count, 0 AS unexplained, 0 AS misnamed, 0 AS gaps FROM placed GROUP BY batch_no, _load_ts)""",
    )
    passed = "SUM(CASE WHEN rejection_reason = '' THEN 1 ELSE 0 END)"
    sql["stream_dq_summary"] = TO_STREAMED + _out(
        "summary_id:i check_date:s total_records:i passed_records:i failed_records:i pass_rate_pct:f top_failure_reason:s",
        f"""(SELECT batch_no AS summary_id, CAST(_load_ts AS DATE) AS check_date, COUNT(*) AS total_records, {passed} AS passed_records,
          COUNT(*) - {passed} AS failed_records, {_pct(passed, 'COUNT(*)')} AS pass_rate_pct, any_value(code) AS top_failure_reason
        FROM checked LEFT JOIN (
          SELECT batch_no, code FROM (
            SELECT batch_no, unnest(string_split(rejection_reason, ' | ')) AS code FROM checked WHERE rejection_reason <> '')
          GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY batch_no ORDER BY COUNT(*) DESC, code) = 1) USING (batch_no)
        GROUP BY batch_no, _load_ts)""",
    )
    sql["stream_gold_check"] = TO_STREAMED + _out(
        "suppliers:i groups:i contract_value:f differing:i",
        """(SELECT COUNT(*) AS suppliers, SUM(contract_value_usd) AS contract_value,
          (SELECT COUNT(*) FROM (SELECT DISTINCT region, category, risk_rating, last_audit_date FROM clean)) AS groups,
          0 AS differing FROM clean)""",
    )
    sql["stream_one_trigger"] = TO_STREAMED + _out(
        _BUS + "record_hash:s version:i is_current:s batch:s",
        """(SELECT * EXCLUDE (batch), 'batch_' || batch_no AS batch,
          row_number() OVER (PARTITION BY supplier_id ORDER BY load_ts) AS version
        FROM versions JOIN (SELECT DISTINCT batch_no, _load_ts AS load_ts, 0 AS batch FROM feed) USING (load_ts))""",
    )
    refusal = "the tables were written by streaming query ?, this is ?: restore its checkpoint, resume with a new one, or use new tables"
    refused = "(SELECT COUNT(*) FROM checked WHERE rejection_reason <> '')"
    closed = "(SELECT COUNT(*) FROM versions WHERE NOT is_current)"
    opened = "(SELECT COUNT(*) FROM versions)"
    held = "(SELECT COUNT(*) + 1 FROM (SELECT DISTINCT region, category, risk_rating FROM clean))"
    moment = "TIMESTAMP '2024-01-01 00:25:00' AS start_time"
    sql["stream_cadence"] = TO_STREAMED + _out(
        "run_id:i task_name:s procedure_name:s start_time:s rows_processed:i rows_inserted:i rows_updated:i rows_rejected:i "
        "status:s error_message:s idle_seen:s",
        f"""(SELECT 1 AS run_id, 'TASK_BRONZE_TO_SILVER' AS task_name, 'SP_BRONZE_TO_SILVER' AS procedure_name, {moment},
          {opened} + {refused} AS rows_processed, {opened} AS rows_inserted, {closed} AS rows_updated, {refused} AS rows_rejected,
          'SUCCESS' AS status, NULL AS error_message, TRUE AS idle_seen
        UNION ALL
        SELECT 2, 'TASK_SILVER_TO_GOLD', 'SP_SILVER_TO_GOLD', {moment}, {held}, {held}, 0, 0, 'SUCCESS', NULL, TRUE
        UNION ALL
        SELECT 3, 'TASK_BRONZE_TO_SILVER', 'SP_BRONZE_TO_SILVER', {moment}, 0, 0, 0, 0, 'FAILED', '{refusal}', TRUE)""",
    )
    return sql
