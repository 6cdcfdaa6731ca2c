"""Raw supplier deliveries and a run log derived from the order-processing test tables.

One delivery per order line, dirtied by fixed rules on a row checksum, in four batches; a
fifth batch delivers part of the fourth again. FIXTURES.md lists every rule. Deriving it
is one scan of the lines with dimension joins: no window, no extra pass for batch five.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vendorium.schemas import PIPELINE_RUN_LOG, RAW_SUPPLIERS, RAW_TEXT, conform
from vendorium.session import read_table, spread

BATCHES = 5
BROADCAST_BYTES = 128 << 20  # parts are broadcast up to this size
_PART_BYTES = 64  # a key and a type in the hash table of a broadcast, rounded up
FEED_TABLES = ("lineitem", "supplier", "nation", "region", "part")
LINE_COLUMNS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_linestatus",
    "l_shipdate",
)


def _every(n: int) -> Column:
    return F.col("h") % n == 0


def _supplier_id() -> Column:
    number = "lpad(cast(l_suppkey as string), greatest(6, length(cast(l_suppkey as string))), '0')"
    return F.concat(F.lit("SUP-"), F.expr(number), F.lit("-"), F.lpad((F.col("l_partkey") % 20).cast("string"), 2, "0"))


def _hundredths(value: Column) -> Column:
    return (value.cast("decimal(10,0)") / 100).cast("decimal(5,2)")


def _percent(text: str) -> Column:
    return F.lit(text).cast("decimal(5,2)")


def batch_time(batch_no: Column) -> Column:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), (batch_no * 5).cast("int"))


def _small(parts: DataFrame) -> DataFrame:
    """Marked for broadcast while all rows, counted from the file's metadata, fit `BROADCAST_BYTES`: the lines then stay
    where they are, and their suppliers' rows together, so that less is left to shuffle after them."""
    return F.broadcast(parts) if parts.count() * _PART_BYTES <= BROADCAST_BYTES else parts


def _delivered(spark: SparkSession, sf_dir: str, most_rows: int | None = None) -> DataFrame:
    """Order lines with their derived columns, the number of their batch `bn`, and whether batch five has them `_again`."""

    def table(name: str) -> DataFrame:
        return read_table(spark, f"{sf_dir}/{name}.parquet")

    checksum = (
        F.col("l_orderkey") * 31 + F.col("l_partkey") * 17 + F.col("l_suppkey") * 7 + F.col("l_linenumber")
    )
    # Parts are joined first: where they are too many to broadcast, lines are shuffled without the suppliers' texts.
    lines = (
        spread(table("lineitem").select(*LINE_COLUMNS), "l_orderkey", most_rows)
        .join(_small(table("part").select("p_partkey", "p_type")), F.col("l_partkey") == F.col("p_partkey"))
        .join(table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("h", checksum)
        .withColumn("bn", (F.col("l_orderkey") % 4 + 1).cast("int"))
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        F.when(~_every(101), _supplier_id()).alias("supplier_id"),
        F.when(_every(103), "  ")
        .when(_every(107), None)
        .otherwise(F.concat(F.lit(" "), F.lower("s_name"), F.lit(" ")))
        .alias("supplier_name"),
        F.when(~_every(109), F.lower("n_name")).alias("country_code"),
        F.when(_every(113), "").otherwise(F.lower("r_name")).alias("region"),
        F.lower("p_type").alias("category"),
        F.when(_every(127), None).when(_every(131), -price).otherwise(price).alias("contract_value_usd"),
        F.when(_every(137), None)
        .when(_every(139), -1)
        .otherwise(F.col("l_quantity").cast("int"))
        .alias("lead_time_days"),
        F.when(_every(149), None)
        .when(_every(151), _percent("100.01"))
        .when(_every(157), _percent("-0.01"))
        .otherwise(_hundredths(F.col("h") % 10001))
        .alias("quality_score"),
        F.when(_every(179), None)
        .when(_every(181), _percent("100.01"))
        .otherwise(_hundredths(F.col("h") * 13 % 10001))
        .alias("on_time_delivery_pct"),
        F.when(_every(163), None)
        .when(F.col("h") % 10 < 2, "high")
        .when(F.col("h") % 10 < 5, "Medium")
        .otherwise(" low ")
        .alias("risk_rating"),
        F.when(~_every(167), F.col("l_shipdate").cast("date")).alias("last_audit_date"),
        F.when(~_every(173), F.col("l_linestatus") == "O").alias("is_active"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_source_row_number"),
        "bn",
        ((F.col("bn") == 4) & (F.col("l_suppkey") % 3 == 0) & ~_every(101)).alias("_again"),
    )


def _raw(batches: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows with their `batch_no` in the shape of Bronze."""
    stem = F.concat(F.lit("suppliers_batch_00"), F.col("batch_no").cast("string"))
    raw = batches.select(
        "*",
        F.concat(F.lit("raw/"), stem, F.lit(".csv")).alias("_source_file_name"),
        batch_time(F.col("batch_no")).alias("_load_ts"),
        stem.alias("_batch_id"),
        F.lit("LOADED").alias("_ingestion_status"),
    )
    wanted = [f for f in RAW_SUPPLIERS if not columns or f.name in columns]
    return raw.select(*[raw[f.name].cast(f.dataType).alias(f.name) for f in wanted], "batch_no")


def _row_columns(delivered: DataFrame) -> list[str]:
    return [name for name in delivered.columns if name not in ("bn", "_again")]


def supplier_feed(spark: SparkSession, sf_dir: str, *columns: str, most_rows: int | None = None) -> DataFrame:
    """Bronze-shaped rows of all five batches, plus `batch_no`; of the derived columns only these, if any are named.
    `most_rows` bounds the lines of a task, see `spread`.

    Rows come out of a generator whole, so columns that a query does not need are best not made: what they are
    derived from is then not read either.
    """
    delivered = _delivered(spark, sf_dir, most_rows)
    # The rows come out of a generator as whole structs. Later filters on them then stay above it:
    # pushed below, each would repeat these derivations and outgrow what the JVM compiles.
    row = [name for name in _row_columns(delivered) if not columns or name in columns]
    first = F.struct(F.col("bn").alias("batch_no"), *row)
    second = F.struct(F.lit(5).alias("batch_no"), *row)
    batches = F.inline(F.when(F.col("_again"), F.array(first, second)).otherwise(F.array(first)))
    return _raw(delivered.select(batches), columns)


def _feed_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed, a branch for each batch: with a filter on `batch_no` only the lines of that batch are derived, as the
    branch's own filter is on columns of the lines and goes down to where they are read."""
    delivered = _delivered(spark, sf_dir)

    def branch(number: int) -> DataFrame:
        lines = delivered.filter("_again") if number == BATCHES else delivered.filter(F.col("bn") == number)
        rows = lines.select(F.inline(F.array(F.struct(*_row_columns(delivered)))))
        return _raw(rows.withColumn("batch_no", F.lit(number)))

    return reduce(DataFrame.unionAll, [branch(number) for number in range(1, BATCHES + 1)])


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline run log derived from the event table, one run per event."""
    event, failed = F.col("event_id"), F.col("event_id") % 11 == 0
    task = F.when(event % 2 == 0, "TASK_BRONZE_TO_SILVER").otherwise("TASK_SILVER_TO_GOLD")
    seconds = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
    start = F.col("ts").cast("timestamp_ntz")
    runs = read_table(spark, f"{sf_dir}/events.parquet").select(
        event.alias("run_id"),
        task.alias("task_name"),
        F.replace(task, F.lit("TASK_"), F.lit("SP_")).alias("procedure_name"),
        start.alias("start_time"),
        (start + seconds).alias("end_time"),
        (event * 37 % 1000).alias("rows_processed"),
        (event % 7).alias("rows_inserted"),
        (event % 5).alias("rows_updated"),
        (event % 3).alias("rows_rejected"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.concat(F.lit("error "), event.cast("string"))).alias("error_message"),
    )
    return conform(runs, PIPELINE_RUN_LOG)


def landing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it would stand in CSV files, with cells that fail, round, quote or span lines.

    A filter on `batch_no` derives the lines of that batch alone.
    """
    feed = _feed_by_batch(spark, sf_dir)
    place = F.col("_source_row_number")

    def at(n: int) -> Column:
        return place % n == 0

    def text(name: str) -> Column:
        return F.col(name).cast("string")

    return feed.select(
        "batch_no",
        place.alias("_order"),
        F.when(at(233), F.rpad("supplier_id", 60, "X")).otherwise(F.col("supplier_id")).alias("supplier_id"),
        F.when(at(227), 'acme, "north" ltd')
        .when(at(239) & (F.col("batch_no") == 3), "two\nlines")
        .otherwise(F.col("supplier_name"))
        .alias("supplier_name"),
        "country_code",
        "region",
        F.when(at(229), "NULL").otherwise(F.col("category")).alias("category"),
        F.when(at(191), "12.34.5").otherwise(text("contract_value_usd")).alias("contract_value_usd"),
        F.when(at(211), "10.7").otherwise(text("lead_time_days")).alias("lead_time_days"),
        F.when(at(193), "n/a")
        .when(at(223), "58.739999999999995")
        .when(at(241), "1000")
        .otherwise(text("quality_score"))
        .alias("quality_score"),
        text("on_time_delivery_pct").alias("on_time_delivery_pct"),
        "risk_rating",
        F.when(at(197), "2022").otherwise(text("last_audit_date")).alias("last_audit_date"),
        F.when(at(199), "maybe").otherwise(F.initcap(text("is_active"))).alias("is_active"),
    )


def line_key() -> Column:
    """Orders lines that share a position; equal keys mean equal lines."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(name), F.lit("")) for name in RAW_TEXT.names]))


def write_landing(texts: DataFrame, folder: str, by_supplier: bool = False) -> None:
    """Write lines as CSV files: names and rows follow the feed's order, or, `by_supplier`, each file holds all lines of
    its suppliers, in order.

    Line keys are not stored or shuffled: as an expression of the sort they are made only for lines that share a position.
    """
    dealt = texts.repartition("supplier_id") if by_supplier else texts.repartitionByRange("_order")
    rows = dealt.sortWithinPartitions("_order", line_key()).select(*RAW_TEXT.names)
    rows.write.options(
        header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(folder)
