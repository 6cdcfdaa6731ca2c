"""The landing files behind the CSV and stream queries, from a few lines made here."""

from __future__ import annotations

from pyspark.sql import functions as F

from vendorium import session
from vendorium.plans import registry
from vendorium.schemas import RAW_TEXT
from vendorium.sources import csv_batches
from vendorium.sources.csv_records import joined_records
from vendorium.sources.feed import BATCHES, FEED_TABLES, landing_text, line_key, supplier_feed, write_landing

CELLS = "S1,acme,DE,EMEA,MRO,10.00,5,80.00,70.00,LOW,2022-01-05,True".split(",")


def _texts(spark, sf):
    rows = [(number, number, *CELLS[:5], f"{number}.00", *CELLS[6:], str(number)) for number in range(1, BATCHES + 1)]
    fields = ["batch_no int", "_order long", *[f"{name} string" for name in RAW_TEXT.names], "_line_key string"]
    return spark.createDataFrame(rows, ", ".join(fields))


def test_one_trigger_streams_once(spark, tmp_path, monkeypatch):
    """The stream of all batches in one trigger must not wait for the stream that takes them one after the other."""
    for table in FEED_TABLES:
        (tmp_path / f"{table}.parquet").write_text("")
    starts = []
    start = registry.SupplierPipeline.start

    def counted(self, *arguments, **options):
        starts.append(options)
        return start(self, *arguments, **options)

    monkeypatch.setattr(registry, "landing_text", _texts)
    monkeypatch.setattr(registry.SupplierPipeline, "start", counted)
    versions = registry.stream_one_trigger(spark, str(tmp_path))
    found = versions.orderBy("version").select("version", "batch", F.col("contract_value_usd").cast("int").alias("value")).collect()
    assert [tuple(row) for row in found] == [(n, f"batch_{n}", n) for n in range(1, BATCHES + 1)]
    assert len(starts) == 2  # the stream, and the start that is refused


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_stay_where_they_are_for_parts(spark, tmp_path):
    """Parts within the bound are broadcast whatever the planner takes their files for, and hashes are shuffled as bytes."""
    tables = {
        "region": "SELECT 1 r_regionkey, 'EMEA' r_name",
        "nation": "SELECT 1 n_nationkey, 'DE' n_name, 1 n_regionkey",
        "supplier": "SELECT id s_suppkey, 'acme' s_name, 1 s_nationkey FROM range(3)",
        "part": "SELECT id p_partkey, 'mro' p_type FROM range(3)",
        "lineitem": "SELECT 102 + id l_orderkey, id % 3 l_partkey, id % 3 l_suppkey, 1 l_linenumber, 5D l_quantity, 10D l_extendedprice,"
        " 'O' l_linestatus, timestamp_ntz'2022-01-05' l_shipdate FROM range(40)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        rows = registry.deliveries(spark, str(tmp_path))
        plan = _plan(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin [l_partkey" in plan
    assert "unhex(" in plan
    found = rows.select("record_hash").collect()
    assert found and all(len(row.record_hash) == 32 and row.record_hash == row.record_hash.lower() for row in found)


def test_rows_are_sorted_in_tasks_of_bounded_size(spark, tmp_path, monkeypatch):
    """Lines are dealt into more tasks than there are cores once a task would sort too many; results stay."""
    tables = {
        "region": "SELECT 1 r_regionkey, 'EMEA' r_name",
        "nation": "SELECT 1 n_nationkey, 'DE' n_name, 1 n_regionkey",
        "supplier": "SELECT id s_suppkey, 'acme' s_name, 1 s_nationkey FROM range(3)",
        "part": "SELECT id p_partkey, 'mro' p_type FROM range(3)",
        "lineitem": "SELECT 102 + id l_orderkey, id % 3 l_partkey, id % 3 l_suppkey, 1 l_linenumber, 5D l_quantity, 10D l_extendedprice,"
        " 'O' l_linestatus, timestamp_ntz'2022-01-05' l_shipdate FROM range(60)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    plain = registry.deliveries(spark, str(tmp_path))
    assert "REPARTITION_BY_NUM" not in _plan(plain) or ", 8), REPARTITION_BY_NUM" in _plan(plain)
    expected = sorted(map(str, plain.collect()))
    monkeypatch.setattr(registry, "SORTED_LINES", 5)
    dealt = registry.deliveries(spark, str(tmp_path))
    assert ", 12), REPARTITION_BY_NUM" in _plan(dealt)
    assert expected and sorted(map(str, dealt.collect())) == expected


def test_row_numbers_are_counted_without_a_row_for_each_line(spark, monkeypatch):
    """Gaps and repeats are seen, and lines are not dealt by their numbers."""
    lines = [("x/batch_1/a.csv", n, "a") for n in (1, 2, 2, 63, 64, 65, 127, 128, 5_000_000_000)]
    lines += [("x/batch_1/b.csv", n, "c") for n in range(1, 200)] + [("x/batch_2/c.csv", 1, "c"), ("x/batch_2/c.csv", 0, "c")]
    parsed = spark.createDataFrame(lines, "_source_file_name string, _source_row_number long, _batch_id string")
    monkeypatch.setattr(registry, "_parsed", lambda spark, sf: parsed)
    counted = registry.csv_row_numbers(spark, "")
    assert "_source_row_number" not in "".join(line for line in _plan(counted).splitlines() if "Exchange" in line)
    found = counted.orderBy("batch").select("batch", "lines", "numbers", "last_number", "stems").collect()
    assert [tuple(row) for row in found] == [("batch_1", 208, 207, 5_000_000_199, 9), ("batch_2", 1, 1, 1, 1)]


def test_records_need_one_pass_over_their_lines(spark, tmp_path):
    """Only lines of records over several lines are gathered: numbers come from the pass that finds the quotes."""
    lines = ["id,name", "1,plain", '2,"two', 'lines"', "", "3,plain", '4,"open', "5,plain", "", "6,plain"]
    (tmp_path / "one.csv").write_text("\n".join(lines) + "\n")
    records = joined_records(csv_batches.split_rows(csv_batches.read_lines(spark, str(tmp_path))))
    assert "Window" not in _plan(records)
    found = records.orderBy("_source_row_number").select("_source_row_number", "value", "_unclosed").collect()
    assert [tuple(row) for row in found] == [
        (0, "id,name", False), (1, "1,plain", False), (2, '2,"two\nlines"', False), (3, "3,plain", False),
        (4, '4,"open', True), (5, "5,plain", False), (6, "6,plain", False),
    ]


def _tables(spark, folder) -> None:
    tables = {
        "region": "SELECT 1 r_regionkey, 'EMEA' r_name",
        "nation": "SELECT 1 n_nationkey, 'DE' n_name, 1 n_regionkey",
        "supplier": "SELECT id s_suppkey, 'acme' s_name, 1 s_nationkey FROM range(3)",
        "part": "SELECT id p_partkey, 'mro' p_type FROM range(3)",
        "lineitem": "SELECT 102 + id l_orderkey, id % 3 l_partkey, id % 3 l_suppkey, 1 l_linenumber, 5D l_quantity, 10D l_extendedprice,"
        " 'O' l_linestatus, timestamp_ntz'2022-01-05' l_shipdate FROM range(40)",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(f"{folder}/{name}.parquet")


def test_texts_of_a_batch_derive_its_lines_alone(spark, tmp_path):
    """All batches are the feed's rows; with a filter one branch is left, whose filter is where the lines are read, and no
    key of a line is made or stored."""
    _tables(spark, tmp_path)
    texts = landing_text(spark, str(tmp_path))
    feed = supplier_feed(spark, str(tmp_path))
    for number in range(1, BATCHES + 1):
        one = texts.filter(F.col("batch_no") == number)
        plan = _plan(one)
        scan = next(line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line)
        assert plan.count("FileScan parquet [l_orderkey") == 1 and "PushedFilters: []" not in scan
        assert "md5" not in plan
        names = ["_source_row_number", "country_code"]
        expected = feed.filter(F.col("batch_no") == number).select(*names)
        found = one.select(F.col("_order").alias(names[0]), "country_code")
        assert found.count() == expected.count() > 0 and found.exceptAll(expected).isEmpty()


def test_lines_that_share_a_position_follow_their_keys(spark, tmp_path):
    """Also though the key is no column of what is shuffled."""
    cells = [f"name {n}" for n in range(30)]
    lines = spark.createDataFrame([(1, n // 10, "S1", *CELLS[1:2], name, *CELLS[3:]) for n, name in enumerate(cells)],
                                  ", ".join(["batch_no int", "_order long", *[f"{name} string" for name in RAW_TEXT.names]]))
    keys = {row[0]: (row[1], row[2]) for row in lines.select(RAW_TEXT.names[2], "_order", line_key()).collect()}
    write_landing(lines, f"{tmp_path}/out", by_supplier=True)
    [file] = [path for path in (tmp_path / "out").glob("*.csv") if path.stat().st_size]
    found = [line.split(",")[2] for line in file.read_text().splitlines()[1:]]
    assert found == sorted(cells, key=keys.get) != cells


def test_ingest_leaves_only_its_rows(spark, tmp_path, monkeypatch):
    """Texts, landing files and steps in between are deleted, rows of files are not cached, shuffle files are released."""
    for table in FEED_TABLES:
        (tmp_path / f"{table}.parquet").write_text("")
    released, levels = [], []

    def texts(spark, sf):
        released.append(spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled"))
        return _texts(spark, sf).withColumn("supplier_name", F.lit("two\nlines"))

    def parse(rows, load_ts):
        levels.append(rows.storageLevel)
        return csv_batches_parse(rows, load_ts)

    csv_batches_parse = csv_batches.parse
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(scratch))
    monkeypatch.setattr(registry, "landing_text", texts)
    monkeypatch.setattr(csv_batches, "parse", parse)
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    found = registry.csv_ingest(spark, str(tmp_path))
    assert sorted(row.batch for row in found.collect()) == [f"batch_{n}" for n in range(1, BATCHES + 1)]
    assert registry.load_log(spark, str(tmp_path)).count() == BATCHES
    kept = [path.name.split("-")[0] for path in scratch.glob("vendorium/*/*")]
    assert kept == ["parsed"]
    assert released == ["true"] and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == before
    assert not any(level.useMemory or level.useDisk for level in levels) and levels


def test_splits_stay_when_cores_come(spark):
    """Two reads of a file must number its lines alike."""
    key = "spark.sql.files.minPartitionNum"
    assert spark.conf.get(key, None) is None
    with session.same_splits(spark):
        assert spark.conf.get(key) == str(spark.sparkContext.defaultParallelism)
    assert spark.conf.get(key, None) is None


def test_reading_is_generated_apart_from_conversions(spark, tmp_path):
    """Together they are a method that is too large to compile."""
    (tmp_path / "one.csv").write_text("\n".join([",".join(CELLS)] * 3))
    rows = csv_batches.split_rows(csv_batches.read_lines(spark, str(tmp_path)))
    parsed = csv_batches.parse(rows, F.lit("2024-01-01").cast("timestamp_ntz"))
    steps = [line.strip(" :+-") for line in _plan(parsed).splitlines()]
    apart = next(n for n, step in enumerate(steps) if step.startswith("Coalesce"))
    assert any("Generate posexplode" in step for step in steps[apart:]) and not any("Generate" in step for step in steps[:apart])
    assert parsed.rdd.getNumPartitions() == rows.rdd.getNumPartitions() and parsed.count() == 3
