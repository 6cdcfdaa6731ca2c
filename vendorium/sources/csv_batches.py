"""Supplier CSV batches: parse, map by position, convert, number the rows, and set bad rows aside.

Files are read as lines, so one huge file is split over many tasks like any other input. Files
in which a quoted field runs over a line end are found exactly and take a longer way that
stays parallel as well. Nothing is read again by name, so a name may hold any character.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vendorium.functions.scalars import file_stem
from vendorium.schemas import BUSINESS, MAX_LENGTH, RAW_TEXT
from vendorium.session import materialize
from vendorium.sources.csv_records import FILE, PLACE, joined_records, open_quote

# The file format, the texts that mean NULL, and the spellings of the flags.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
NULL_TEXTS = ("NULL", "null", "")
TRUE_TEXTS = ("true", "t", "yes", "y", "on", "1")
FALSE_TEXTS = ("false", "f", "no", "n", "off", "0")
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"
OTHER_DATES = ((r"^\d{1,2}/\d{1,2}/\d{4}$", "M/d/yyyy"), (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"))
UNCLOSED = "quoted field is not closed in the file"
LINE_FEED = {"lineSep": "\n"}  # carriage returns stay, so that those inside quotes can be given back
BROADCAST_BYTES = 128 << 20  # offsets of splits are broadcast up to this size
_ANY_PARTITIONS = 1 << 20  # no fewer than a read has, so that `coalesce` leaves them as they are
_OFFSET_BYTES = 64  # a row of four numbers in the hash table of a broadcast, rounded up


def file_name(path: Column) -> Column:
    """Readable path: the metadata column is percent-encoded, and a plain '+' must stay one. Most paths have nothing to
    decode."""
    return F.when(F.contains(path, F.lit("%")), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def _located(df: DataFrame, first_name: Callable[[Column], Column]) -> DataFrame:
    """Name the file with its time, the split of it, and the row's place; places rise in file order within a split."""
    return df.select(
        "*",
        first_name(file_name(F.col("_metadata.file_path"))).alias("_source_file_name"),
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_place"),
    )


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.options(**LINE_FEED).text(path).select("value", "_metadata")


# Longer than any file can be old. The file source forgets, and never loads, files older than `maxFileAge` before the
# newest one, so a backfill needs a span that none exceeds. In turn the checkpoint keeps every file name.
MAX_FILE_AGE = "36500d"


def stream_lines(spark: SparkSession, path: str, **limits: str) -> DataFrame:
    """New files of a folder, or of a pattern of folders, as they arrive, whatever their times.

    `limits` are reader options such as maxBytesPerTrigger; maxFileAge is `MAX_FILE_AGE` unless given. The file
    source passes over names that begin with `_` or `.`; the ledger offers those under other names.
    """
    options = {"recursiveFileLookup": "true", "maxFileAge": MAX_FILE_AGE, **LINE_FEED, **limits}
    reader = spark.readStream.options(**options)
    return reader.text(path).select("value", "_metadata")


def _cut_at_returns(lines: DataFrame) -> DataFrame:
    """Lines that end in LF, CR LF or CR, each with its `_end`."""
    value = F.col("value")
    windows = value.endswith("\r")
    body = F.when(windows, F.expr("left(value, length(value) - 1)")).otherwise(value)
    parts = F.when(F.instr(body, "\r") > 0, F.split(body, "\r")).otherwise(F.array(body))
    each = lines.select("*", F.posexplode(parts).alias("_part", "_line"), F.size(parts).alias("_parts"), windows.alias("_windows"))
    last = F.col("_part") == F.col("_parts") - 1
    end = F.when(~last, F.lit("\r")).when(F.col("_windows"), F.lit("\r\n")).otherwise(F.lit("\n"))
    return each.select(F.col("_line").alias("value"), end.alias("_end"), "_metadata")


def split_rows(lines: DataFrame, first_name: Callable[[Column], Column] = lambda name: name) -> DataFrame:
    """All lines with their end, file, split and place, and whether each is blank or ends inside quotes.

    `first_name` gives the name of a file from the one that it was read under.
    """
    kept = _located(_cut_at_returns(lines), first_name)
    blank = F.trim("value") == ""
    return kept.select("value", "_end", blank.alias("_blank"), (~blank & open_quote(F.col("value"))).alias("_open"), "_file_time", *PLACE)


def _counted(rows: DataFrame) -> DataFrame:
    """Rows that are not blank, numbered without gaps within their task."""
    return rows.filter(~F.col("_blank")).withColumn("_dense", F.monotonically_increasing_id())


def _splits(rows: DataFrame) -> DataFrame:
    """One row per split of a file: its rows, the number of its first one, and whether a line of it ends inside quotes."""
    splits = _counted(rows).groupBy(FILE, "_split").agg(
        F.count("*").alias("_rows"), F.min("_dense").alias("_first"), F.max("_open").alias("_open")
    )
    return materialize(splits, "splits")


def _offsets(splits: DataFrame) -> DataFrame:
    """For each split, by the hash of its file and start: how far its rows' numbers are from those in the file, and
    whether the file has records over several lines. The window runs over one row per split."""
    in_file = Window.partitionBy(FILE)
    earlier = in_file.orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    return splits.select(
        F.xxhash64(FILE, "_split").alias("_key"), before.alias("_shift"), F.max("_open").over(in_file).alias("_multi"), FILE, "_split"
    )


def with_offsets(rows: DataFrame, splits: DataFrame, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join each row to its split's offset.

    A split goes by one number, the hash of its file and start, if no two splits share one. Its row then takes some 60
    bytes whatever the file names, and the splits are broadcast as long as all of them fit `most_bytes`: two million
    splits. Beyond that, or with equal hashes, the join shuffles by file and split, one split's rows per key.
    """
    offsets = _offsets(splits)
    number, different = offsets.agg(F.count("*"), F.count_distinct("_key")).first()
    if number == different:
        keyed = rows.withColumn("_key", F.xxhash64(FILE, "_split"))
        small = offsets.select("_key", "_shift", "_multi")
        return keyed.join(F.broadcast(small) if number * _OFFSET_BYTES <= most_bytes else small, "_key").drop("_key")
    return rows.join(offsets.drop("_key"), [FILE, "_split"])


def _numbered(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of files whose records are single lines, with each row's number in its file, the header being 0.

    The rows of a split are consecutive within one task, so a row's number is the rows of
    the file's earlier splits plus its distance from the split's first row.
    """
    joined = with_offsets(_counted(rows), splits).filter(~F.col("_multi"))
    number = (F.col("_dense") + F.col("_shift")).cast("long")
    return joined.select("value", F.lit(False).alias("_unclosed"), FILE, "_file_time", number.alias("_source_row_number"))


def _converted(name: str, kind: str, raw: Column) -> Column:
    if kind == "string":
        return raw
    if kind == "int":
        return raw.try_cast("decimal(38,0)").try_cast("int")
    if kind == "date":
        found = F.when(raw.rlike(DATE_PATTERN), raw.try_cast("date"))
        for pattern, form in OTHER_DATES:
            found = found.when(raw.rlike(pattern), F.try_to_timestamp(F.initcap(raw), F.lit(form)).cast("date"))
        return found
    if kind == "boolean":
        flag = F.lower(raw)
        return F.when(flag.isin(*TRUE_TEXTS), True).when(flag.isin(*FALSE_TEXTS), False)
    return raw.try_cast(kind)


def typed(records: DataFrame, load_ts: Column) -> DataFrame:
    """Map the twelve fields by position to typed columns, with `_error` naming the first that fails.

    The conversions are more code than the JVM compiles as one method and are generated in pieces, which is slow for all
    steps that would be one method with them. So `coalesce`, to more partitions than there are, sets them apart from
    the reading and numbering of lines.
    """
    kinds = ", ".join(f"{name} string" for name in RAW_TEXT.names)
    numbered = records.coalesce(_ANY_PARTITIONS).withColumn("_text", F.from_csv("value", kinds, CSV_OPTIONS))
    text = {f.name: F.col(f"_text.{f.name}") for f in BUSINESS}
    cells = {name: F.when(~cell.isin(*NULL_TEXTS), cell) for name, cell in text.items()}
    lineage = (FILE, "_file_time", "_source_row_number")
    raw = numbered.select(*[cells[name].alias(f"_raw_{name}") for name in cells], "_unclosed", *lineage)
    values = [
        _converted(f.name, f.dataType.simpleString(), F.col(f"_raw_{f.name}")).alias(f.name) for f in BUSINESS
    ]
    problems = [F.when(F.col("_unclosed"), F.lit(UNCLOSED))]
    for field in BUSINESS:
        cell = F.col(f"_raw_{field.name}")
        if field.name in MAX_LENGTH:
            bad, label = F.length(cell) > MAX_LENGTH[field.name], "too long"
        else:
            bad, label = cell.isNotNull() & F.col(field.name).isNull(), "cannot convert"
        problems.append(F.when(bad, F.concat(F.lit(f"{field.name}: {label}: "), cell)))
    header = F.col("_source_row_number") == 0
    checked = raw.select("*", *values).withColumn("_problem", F.coalesce(*problems))
    return checked.select(
        *BUSINESS.names,
        FILE,
        "_source_row_number",
        load_ts.alias("_load_ts"),
        file_stem(F.col(FILE)).alias("_batch_id"),
        F.lit("LOADED").alias("_ingestion_status"),
        F.when(~header, F.col("_problem")).alias("_error"),
        (~header & F.col("_problem").isNull()).alias("_loaded"),
        "_file_time",
    )


def parse(rows: DataFrame, load_ts: Column) -> DataFrame:
    """All rows of `split_rows` converted, with their `_error`; row 0 of a file is its header.

    `rows` are read more than once, and the result is read once: building a cache of them takes longer than reading
    files again, and what memory does not hold of it goes to disk. The caller sees to it that all reads have the same
    splits, by `same_splits`, unless `rows` stand on one RDD, as those of a stream's batch do. `_file_time` is the file's
    modification time.
    """
    splits = _splits(rows)
    by_line = _numbered(rows, splits)
    multi = splits.filter("_open").select(FILE).distinct()
    if multi.isEmpty():
        return typed(by_line, load_ts)
    records = joined_records(rows.join(multi, FILE, "left_semi"))
    return typed(by_line.unionByName(records), load_ts)
