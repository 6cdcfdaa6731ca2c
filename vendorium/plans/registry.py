"""Every registered query: (session, folder of test tables) -> DataFrame over whole tables."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime, timedelta
from functools import cache
from typing import Any

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from vendorium.functions.quality import is_blank
from vendorium.functions.scalars import count_where, days_since, file_stem, seconds_between
from vendorium.operators import history, latest, routing
from vendorium.operators.numbering import number_rows
from vendorium.plans import audit, dashboard, gold
from vendorium.plans.oracle import AS_OF, RUN_TS
from vendorium.schemas import BUSINESS_COLUMNS, DIM_SUPPLIERS, RAW_SUPPLIERS, SUPPLIERS_CLEAN
from vendorium.session import delete_folder, discarding_scratch, materialize, releasing_shuffles, same_splits, scratch_path
from vendorium.sources import csv_batches
from vendorium.sources.feed import BATCHES, FEED_TABLES, batch_time, landing_text, run_log, supplier_feed, write_landing
from vendorium.sources.tables import Folder, SupplierTables
from vendorium.streaming.pipeline import PIPE, SupplierPipeline

Query = Callable[[SparkSession, str], DataFrame]

SORTED_LINES = 750_000  # order lines of a task that sorts their rows: some 600 bytes each while they are sorted
_WORD_BITS = 6  # one long marks 2**6 row numbers


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def run_ts() -> Column:
    return F.lit(RUN_TS).cast("timestamp_ntz")


def comparable(df: DataFrame) -> DataFrame:
    """Plain types only: decimals as doubles, whole numbers as longs, flags, dates and times as text."""

    def plain(field: T.StructField) -> Column:
        if isinstance(field.dataType, T.DecimalType):
            kind = "double"
        elif isinstance(field.dataType, T.IntegerType):
            kind = "bigint"
        elif isinstance(field.dataType, (T.BooleanType, T.DateType, T.TimestampNTZType)):
            kind = "string"
        else:
            return F.col(field.name)
        return F.col(field.name).cast(kind).alias(field.name)

    return df.select([plain(field) for field in df.schema])


# Stages of the chain that the queries share.


def flagged(spark: SparkSession, sf: str) -> DataFrame:
    return routing.flag(supplier_feed(spark, sf))


def accepted(spark: SparkSession, sf: str) -> DataFrame:
    return routing.accepted(flagged(spark, sf))


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """The last accepted row of each supplier in each batch. Hashes are shuffled as bytes, which sort like their text.

    Each task sorts its whole rows to send one per supplier and batch, so tasks are kept to lines that sort in memory.
    """
    lines = routing.flag(supplier_feed(spark, sf, most_rows=SORTED_LINES))
    packed = routing.accepted(lines).withColumn("record_hash", F.unhex("record_hash"))
    newest = latest.latest_per_key(packed, ("supplier_id", "load_ts"))
    return newest.withColumn("record_hash", F.lower(F.hex("record_hash")))


def versions(spark: SparkSession, sf: str) -> DataFrame:
    return history.rebuild(deliveries(spark, sf))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return history.clean_state(versions(spark, sf))


def stored(stage: Query) -> Query:
    """A stage that is written out first, for reports that read it more than once."""
    return lambda spark, sf: materialize(stage(spark, sf), stage.__name__)


# Queries that are more than one call.


def dq_flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = flagged(spark, sf).groupBy("batch_no", F.col("_dq_passed").alias("dq_passed"))
    return counted.agg(F.count("*").alias("records"))


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    return routing.rejects(flagged(spark, sf), F.col("_load_ts"))


def rejection_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_rows(spark, sf).groupBy("rejection_reason").agg(F.count("*").alias("records"))


def _each_batch(written: DataFrame) -> list[tuple[Column, DataFrame]]:
    times = [batch_time(F.lit(number)) for number in range(1, BATCHES + 1)]
    return [(ts, written.filter(F.col("load_ts") == ts)) for ts in times]


def _upserted(written: DataFrame) -> DataFrame:
    state = written.sparkSession.createDataFrame([], SUPPLIERS_CLEAN)
    for ts, batch in _each_batch(written):
        state = history.upsert(state, batch, ts)
    return state


def upsert_clean_state(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(stored(deliveries)(spark, sf))


def scd2_fold(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([field for field in DIM_SUPPLIERS if field.name != "supplier_sk"])
    dimension = spark.createDataFrame([], schema)
    for ts, batch in _each_batch(stored(deliveries)(spark, sf)):
        dimension = history.fold(dimension, batch, ts)
    return dimension


def _compared(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deliveries, the version each one meets, and those versions that it expires."""
    written = stored(deliveries)(spark, sf)
    meets = F.expr("lead(load_ts) OVER (PARTITION BY supplier_id ORDER BY load_ts)")
    current = written.select("supplier_id", "record_hash", meets.alias("load_ts")).filter("load_ts IS NOT NULL")
    return written, current, history.changed(current, written, ("supplier_id", "load_ts"))


def scd2_expired_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    _, _, expired = _compared(spark, sf)
    return expired.groupBy("load_ts").agg(F.count("*").alias("expired"))


def new_versions_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    keys = ("supplier_id", "load_ts")
    written, current, expired = _compared(spark, sf)
    unexpired = history.without_current(current, expired, keys)
    opened = history.without_current(written, unexpired, keys)
    return opened.groupBy("load_ts").agg(F.count("*").alias("opened"))


def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    def count(df: DataFrame, name: str) -> DataFrame:
        return latest.duplicate_keys(df, "supplier_id").agg(F.count("*").alias(name))

    written = stored(deliveries)(spark, sf)
    in_clean = count(history.clean_state(history.rebuild(written)), "clean_duplicates")
    return count(written, "delivery_duplicates").withColumn("clean_duplicates", in_clean.scalar())


def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """The folded current state against the rebuilt history: two ways that must agree."""
    written = stored(deliveries)(spark, sf)
    differing = history.reconcile(_upserted(written), history.rebuild(written))
    return differing.agg(F.count("*").alias("disagreeing"))


def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = versions(spark, sf).select("supplier_id", "valid_from")
    return number_rows(keys, "supplier_sk", ("supplier_id", "valid_from"))


def raw_latest(spark: SparkSession, sf: str) -> DataFrame:
    return latest.newest_raw_first(supplier_feed(spark, sf)).select(*RAW_SUPPLIERS.names)


def predicates(spark: SparkSession, sf: str) -> DataFrame:
    quality = F.col("quality_score")
    grade = F.when(quality < 70, "LOW").when(quality < 90, "MID").when(quality.isNull(), "NONE").otherwise("TOP")
    return supplier_feed(spark, sf, "_source_file_name", "_source_row_number", "category", "supplier_name", "region", "country_code", "quality_score", "on_time_delivery_pct", "contract_value_usd", "lead_time_days", "risk_rating", "is_active").select(
        "_source_file_name",
        "_source_row_number",
        "category",
        is_blank("supplier_name").alias("blank_name"),
        is_blank("region").alias("blank_region"),
        is_blank("country_code").alias("blank_country"),
        (~quality.between(0, 100)).alias("quality_outside"),
        (~F.col("on_time_delivery_pct").between(0, 100)).alias("on_time_outside"),
        (F.col("contract_value_usd") < 0).alias("negative_value"),
        (F.col("lead_time_days") < 0).alias("negative_lead"),
        (((F.col("risk_rating") != "high") & (quality < 75)) | F.col("is_active")).alias("watched"),
        grade.alias("grade"),
        F.lit("feed").alias("source"),
    )


def conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    return supplier_feed(spark, sf, "category", "risk_rating", "is_active", "last_audit_date").groupBy("category").agg(
        F.count("*").alias("deliveries"),
        count_where(F.col("risk_rating") == "high").alias("high"),
        count_where(~F.col("is_active")).alias("inactive"),
        count_where(F.col("last_audit_date").isNull()).alias("unaudited"),
    )


def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    barred = F.concat(F.lit("| "), F.col("country_code"), F.lit(" | "))
    return supplier_feed(spark, sf, "_source_file_name", "_source_row_number", "category", "supplier_name", "country_code", "risk_rating", "supplier_id", "contract_value_usd", "quality_score").select(
        "_source_file_name",
        "_source_row_number",
        "category",
        F.trim("supplier_name").alias("trimmed"),
        F.btrim(barred, F.lit("| ")).alias("bars_trimmed"),
        F.upper("risk_rating").alias("uppered"),
        F.concat("supplier_id", F.lit("|"), "country_code").alias("joined"),
        F.coalesce("supplier_id", F.lit("")).alias("filled"),
        F.col("contract_value_usd").cast("string").alias("value_text"),
        F.col("quality_score").cast("string").alias("score_text"),
        file_stem(F.col("_source_file_name")).alias("stem"),
    )


def numeric_functions(spark: SparkSession, sf: str) -> DataFrame:
    quality, on_time = F.col("quality_score"), F.col("on_time_delivery_pct")
    return supplier_feed(spark, sf, "_source_file_name", "_source_row_number", "category", "quality_score", "on_time_delivery_pct", "lead_time_days").select(
        "_source_file_name",
        "_source_row_number",
        "category",
        F.round(quality, 1).alias("rounded"),
        F.ceil(quality).cast("bigint").alias("score_up"),
        F.nullif("lead_time_days", F.lit(10)).alias("lead_or_null"),
        (quality + on_time).alias("total"),
        (quality - on_time).alias("gap"),
        (quality * F.lit("0.4").cast("decimal(2,1)")).alias("weighted"),
        (F.col("lead_time_days") / F.lit(30).cast("decimal(3,1)")).alias("lead_share"),
    )


def date_functions(spark: SparkSession, sf: str) -> DataFrame:
    return run_log(spark, sf).select(
        "run_id",
        days_since("start_time", as_of()).alias("days_since"),
        F.trunc("start_time", "MM").alias("month_start"),
        seconds_between(F.col("start_time"), F.col("end_time")).alias("seconds"),
        run_ts().alias("stamped"),
        as_of().alias("as_of"),
    )


# The feed as CSV files, ingested in one go and as a stream of five batches.


def _inputs(spark: SparkSession, sf: str) -> str:
    """Names, sizes and times of the files that the feed is made of: work on other files is not taken for this one."""
    files = spark._jvm.org.apache.hadoop.fs
    parts = []
    for table in FEED_TABLES:
        path = files.Path(f"{sf}/{table}.parquet")
        for status in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            parts.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return "\n".join(parts)


def _once(work: Callable[[SparkSession, str, str], Any]) -> Callable[[SparkSession, str], Any]:
    """Do `work` once per session, folder and state of its files."""

    @cache
    def kept(spark: SparkSession, sf: str, inputs: str) -> Any:
        with releasing_shuffles(spark):
            return work(spark, sf, inputs)

    return lambda spark, sf: kept(spark, sf, _inputs(spark, sf))


@_once
def _texts(spark: SparkSession, sf: str, _: str) -> DataFrame:
    """Not stored: each batch is derived when it lands, which costs no more than reading all of them for each batch."""
    return landing_text(spark, sf)


def _write_batch(spark: SparkSession, sf: str, number: int, landing: str, by_supplier: bool = False) -> None:
    texts = _texts(spark, sf).filter(F.col("batch_no") == number)
    with discarding_scratch(spark):
        # Ranges come from a sample, for which the lines would be derived a second time.
        write_landing(texts if by_supplier else materialize(texts, "texts"), f"{landing}/batch_{number}", by_supplier)


def _landed(spark: SparkSession, sf: str) -> str:
    """A folder with one folder of CSV files per batch."""
    folder = scratch_path(spark, "landing")
    for number in range(1, BATCHES + 1):
        _write_batch(spark, sf, number, folder)
    return folder


def _landing_batch(path: str) -> Column:
    return F.split_part(F.col(path), F.lit("/"), F.lit(-2))


@_once
def _parsed(spark: SparkSession, sf: str, _: str) -> DataFrame:
    """All records of the landing files, which are deleted once they are read."""
    landing = _landed(spark, sf)
    with discarding_scratch(spark), same_splits(spark):
        rows = csv_batches.split_rows(csv_batches.read_lines(spark, f"{landing}/*"))
        stored = materialize(csv_batches.parse(rows, run_ts()), "parsed", keep=True)
    delete_folder(spark, landing)
    return stored


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    loaded = _parsed(spark, sf).filter("_loaded")
    return loaded.select(*BUSINESS_COLUMNS, _landing_batch("_source_file_name").alias("batch"), "_ingestion_status")


def csv_row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per batch, counted and by the highest row number of each file: equal if numbering is dense."""
    rows = _parsed(spark, sf).filter("_source_row_number > 0")
    number = F.col("_source_row_number")
    # Distinct numbers are marked as bits, so that tasks hold and send a row for each word of them and not for each line.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (number % (1 << _WORD_BITS)).cast("int"))
    per_word = rows.groupBy("_source_file_name", F.shiftright(number, _WORD_BITS).alias("_word")).agg(
        F.count("*").alias("lines"),
        F.bit_or(bit).alias("_bits"),
        F.max(number).alias("last_number"),
        F.count_if(F.col("_batch_id") == csv_batches.file_stem(F.col("_source_file_name"))).alias("stems"),
    )
    per_file = per_word.groupBy("_source_file_name").agg(
        F.sum("lines").alias("lines"),
        F.sum(F.bit_count("_bits")).alias("numbers"),
        F.max("last_number").alias("last_number"),
        F.sum("stems").alias("stems"),
    )
    return per_file.groupBy(_landing_batch("_source_file_name").alias("batch")).agg(
        *[F.sum(name).alias(name) for name in ("lines", "numbers", "last_number", "stems")]
    )


def load_log(spark: SparkSession, sf: str) -> DataFrame:
    """The per-file load log, summed up by batch; the first error is that of the first file with one."""
    log = audit.load_log(_parsed(spark, sf), PIPE, run_ts())
    return log.groupBy(_landing_batch("file_name").alias("batch"), "pipe_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("error_count").alias("error_count"),
        F.min_by("first_error", F.when(F.col("error_count") > 0, F.col("file_name"))).alias("first_error"),
        F.max((F.col("load_status") == "LOAD_FAILED").cast("int")).alias("failed_files"),
    )


@_once
def _tables(spark: SparkSession, sf: str, _: str) -> SupplierTables:
    """The tables after streaming the five batches one after the other."""
    root = scratch_path(spark, "stream")
    tables = SupplierTables(spark, f"{root}/tables")
    for number in range(1, BATCHES + 1):
        now = datetime(2024, 1, 1) + timedelta(minutes=5 * number)
        _write_batch(spark, sf, number, f"{root}/landing", by_supplier=True)
        SupplierPipeline(tables, lambda now=now: now).start(f"{root}/landing").awaitTermination()
    return tables


@_once
def _cadenced(spark: SparkSession, sf: str, _: str) -> tuple[SupplierTables, bool]:
    """The tables after all batches in one trigger of a stream that then finds a file without rows and nothing more; last
    its checkpoint is lost and a start with another one refused. And whether idle triggers were seen.

    The landing files are written for this stream alone: taking those of `_tables` would mean to stream them before.
    """
    root = scratch_path(spark, "cadence")
    landing, tables = f"{root}/landing", SupplierTables(spark, f"{root}/tables")
    for number in range(1, BATCHES + 1):
        _write_batch(spark, sf, number, landing, by_supplier=True)
    pipeline = SupplierPipeline(tables, lambda: datetime(2024, 1, 1, 0, 25))
    query = pipeline.start(landing, every="1 second")
    try:
        query.processAllAvailable()
        Folder(spark, landing).replace("none.csv", ",".join(BUSINESS_COLUMNS) + "\n")
        query.processAllAvailable()
        ends = time.monotonic() + 60
        while not pipeline.triggers.idle and time.monotonic() < ends:
            time.sleep(0.2)
    finally:
        query.stop()
        pipeline.triggers.stop(spark)
    tables.folder.delete("_checkpoint")
    try:
        pipeline.start(landing).awaitTermination()
    except StreamingQueryException:
        pass  # logged as a failed run, which the query shows
    return tables, pipeline.triggers.idle > 0


def stream_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).dimension().drop("source_file_name", "source_row_number")


def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).clean().drop("source_file_name", "source_row_number")


def stream_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).rejected().drop("reject_id", "source_file_name", "source_row_number")


def stream_run_log(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).run_log().drop("end_time")


def stream_kpi(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).kpi_snapshot()


def stream_raw(spark: SparkSession, sf: str) -> DataFrame:
    raw = _tables(spark, sf).raw()
    return raw.select(*BUSINESS_COLUMNS, _landing_batch("_source_file_name").alias("batch"), "_load_ts", "_ingestion_status")


def stream_load_log(spark: SparkSession, sf: str) -> DataFrame:
    """The stored load log by batch; its numbers must run from 1 without gaps."""
    log = _tables(spark, sf).load_log()
    by_batch = log.groupBy(_landing_batch("file_name").alias("batch"), "pipe_name", "load_ts").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("error_count").alias("error_count"),
        F.count_if(F.col("first_error").isNotNull() != (F.col("error_count") > 0)).alias("unexplained"),
        F.count_if((F.col("load_status") == "LOADED") != (F.col("error_count") == 0)).alias("misnamed"),
    )
    gaps = log.agg((F.max("log_id") - F.count_distinct("log_id")).alias("gaps")).scalar()
    return by_batch.withColumn("gaps", gaps)


def stream_dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _tables(spark, sf).dq_summary()


def stream_agg_risk_spend(spark: SparkSession, sf: str) -> DataFrame:
    """The stored aggregate, refreshed from the changes of each batch."""
    return _tables(spark, sf).agg_risk_spend()


def stream_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension once its batches are folded into files of id ranges; all other reads stay as they were."""
    tables = _tables(spark, sf)
    tables.fold()
    return tables.dimension().drop("source_file_name", "source_row_number")


def stream_gold_check(spark: SparkSession, sf: str) -> DataFrame:
    """The state that Gold was refreshed to, change by change, and all open versions counted anew."""
    tables = _tables(spark, sf)
    kept, anew = tables.gold_state(), gold.state_of(tables.current())
    return kept.agg(
        F.sum("suppliers").alias("suppliers"), F.count("*").alias("groups"), F.sum("contract_value").alias("contract_value")
    ).withColumn("differing", kept.exceptAll(anew).unionByName(anew.exceptAll(kept)).agg(F.count("*")).scalar())


def stream_one_trigger(spark: SparkSession, sf: str) -> DataFrame:
    """All versions of each supplier in order, from all batches in one trigger."""
    nth = F.row_number().over(Window.partitionBy("supplier_id").orderBy("valid_from"))
    rows = _cadenced(spark, sf)[0].dimension().withColumn("version", nth)
    return rows.select(*BUSINESS_COLUMNS, "record_hash", "version", "is_current", _landing_batch("source_file_name").alias("batch"))


def stream_cadence(spark: SparkSession, sf: str) -> DataFrame:
    """What that stream logged: one run for each stage, none for the file without rows or idle triggers, one refusal."""
    tables, idle = _cadenced(spark, sf)
    message = F.regexp_replace("error_message", "[0-9a-f]{8}-[0-9a-f-]{27}", "?")
    return tables.run_log().drop("end_time").withColumns({"error_message": message, "idle_seen": F.lit(idle)})


def _on(stage: Query, report: Callable[..., DataFrame], *arguments: Callable[[], Column]) -> Query:
    """A query that is one report over one stage; clock arguments are built when it runs."""
    return lambda spark, sf: report(stage(spark, sf), *[argument() for argument in arguments])


def _kpi(spark: SparkSession, sf: str) -> DataFrame:
    dimension = stored(versions)(spark, sf)
    return gold.kpi_snapshot(history.clean_state(dimension), dimension, as_of(), run_ts())


def all_queries() -> dict[str, Query]:
    plain: dict[str, Query] = {
        "dq_flag_counts": dq_flag_counts,
        "rejected_rows": rejected_rows,
        "rejection_reasons": rejection_reasons,
        "rule_failures": _on(supplier_feed, routing.reason_counts),
        "dq_summary": _on(supplier_feed, routing.quality_summary, as_of),
        "standardised_clean": lambda spark, sf: accepted(spark, sf).select(
            "supplier_id", "supplier_name", "country_code", "region", "category", "risk_rating",
            "source_file_name", "source_row_number",
        ),
        "record_hash": lambda spark, sf: accepted(spark, sf).select(
            "supplier_id", "source_file_name", "source_row_number", "record_hash"
        ),
        "latest_per_batch": lambda spark, sf: deliveries(spark, sf).select(*SUPPLIERS_CLEAN.names),
        "upsert_clean_state": upsert_clean_state,
        "clean_state": clean,
        "scd2_fold": scd2_fold,
        "scd2_rebuild": versions,
        "scd2_expired_by_batch": scd2_expired_by_batch,
        "new_versions_by_batch": new_versions_by_batch,
        "version_counts": _on(versions, history.version_counts),
        "duplicate_keys": duplicate_keys,
        "reconcile": reconcile,
        "surrogate_keys": surrogate_keys,
        "raw_latest": raw_latest,
        "regional_summary": _on(clean, gold.regional_summary),
        "category_summary": _on(clean, gold.category_summary),
        "monthly_trends": _on(clean, gold.monthly_trends),
        "agg_risk_spend": _on(clean, gold.agg_risk_spend, run_ts),
        "dq_pass_rate": _on(versions, gold.dq_pass_rate),
        "kpi_snapshot": _kpi,
        "kpi_dashboard": _on(clean, dashboard.headline_figures),
        "dashboard_regional": _on(clean, dashboard.regional_charts),
        "dashboard_category": _on(clean, dashboard.category_charts),
        "risk_scorecard": _on(clean, gold.risk_scorecard, as_of),
        "risk_list": lambda spark, sf: dashboard.risk_list(
            clean(spark, sf), as_of(), ("CRITICAL", "WATCH", "OK")
        ),
        "risk_levels": _on(clean, dashboard.risk_levels, as_of),
        "supplier_rankings": _on(stored(clean), gold.supplier_rankings),
        "top20_suppliers": _on(stored(clean), dashboard.top_suppliers),
        "tier_distribution": _on(stored(clean), dashboard.tier_distribution),
        "recent_runs": _on(run_log, audit.recent_runs),
        "last10_runs": _on(run_log, audit.last_runs),
        "pipeline_health": _on(run_log, audit.pipeline_health),
        "predicates": predicates,
        "conditional_counts": conditional_counts,
        "text_functions": text_functions,
        "numeric_functions": numeric_functions,
        "date_functions": date_functions,
        "csv_ingest": csv_ingest,
        "csv_row_numbers": csv_row_numbers,
        "load_log": load_log,
        "stream_dimension": stream_dimension,
        "stream_clean": stream_clean,
        "stream_rejected": stream_rejected,
        "stream_run_log": stream_run_log,
        "stream_kpi": stream_kpi,
        "stream_raw": stream_raw,
        "stream_load_log": stream_load_log,
        "stream_dq_summary": stream_dq_summary,
        "stream_agg_risk_spend": stream_agg_risk_spend,
        "stream_folded": stream_folded,
        "stream_gold_check": stream_gold_check,
        "stream_one_trigger": stream_one_trigger,
        "stream_cadence": stream_cadence,
    }
    return {name: _compared_types(query) for name, query in plain.items()}


def _compared_types(query: Query) -> Query:
    return lambda spark, sf: comparable(query(spark, sf))
