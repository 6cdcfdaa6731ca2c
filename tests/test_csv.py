from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from vendorium.plans.audit import load_log
from vendorium.schemas import BUSINESS_COLUMNS
from vendorium.sources import csv_batches, csv_records
from vendorium.sources.csv_records import still_open

HEADER = ",".join(BUSINESS_COLUMNS) + "\n"


def _stamp():
    return F.lit("2024-01-01").cast("timestamp_ntz")


def _line(**cells) -> str:
    good = dict(zip(BUSINESS_COLUMNS, "S1,acme,DE,EMEA,MRO,10.00,5,80.00,70.00,LOW,2022-01-05,True".split(",")))
    return ",".join({**good, **cells}.values()) + "\n"


def _parse(spark, folder):
    return csv_batches.parse(csv_batches.split_rows(csv_batches.read_lines(spark, str(folder))), _stamp())


def _one(spark, tmp_path, line: str):
    (tmp_path / "one.csv").write_text(HEADER + line)
    return _parse(spark, tmp_path).filter("_source_row_number = 1").first()


LOADS = [
    ({"supplier_name": '"a, b"'}, "supplier_name", "a, b"),
    ({"supplier_name": '"say ""hi"""'}, "supplier_name", 'say "hi"'),
    ({"supplier_name": '5" pipe'}, "supplier_name", '5" pipe'),
    ({"supplier_name": "  spaced  "}, "supplier_name", "spaced"),
    ({"region": "NULL"}, "region", None),
    ({"region": "null"}, "region", None),
    ({"region": ""}, "region", None),
    ({"region": "Null"}, "region", "Null"),
    ({"lead_time_days": "10.7"}, "lead_time_days", 11),
    ({"quality_score": "58.739999999999995"}, "quality_score", "58.74"),
    ({"quality_score": "100.01"}, "quality_score", "100.01"),
    ({"last_audit_date": "2022-1-5"}, "last_audit_date", "2022-01-05"),
    ({"last_audit_date": "1/15/2022"}, "last_audit_date", "2022-01-15"),
    ({"last_audit_date": "5-JAN-2022"}, "last_audit_date", "2022-01-05"),
    ({"is_active": "on"}, "is_active", True),
    ({"is_active": "N"}, "is_active", False),
]
FAILS = [
    ({"contract_value_usd": "1.2.3"}, "contract_value_usd: cannot convert: 1.2.3"),
    ({"lead_time_days": "soon"}, "lead_time_days: cannot convert: soon"),
    ({"lead_time_days": "3000000000"}, "lead_time_days: cannot convert: 3000000000"),
    ({"quality_score": "1000"}, "quality_score: cannot convert: 1000"),
    ({"last_audit_date": "2022"}, "last_audit_date: cannot convert: 2022"),
    ({"last_audit_date": "2022-02-30"}, "last_audit_date: cannot convert: 2022-02-30"),
    ({"last_audit_date": "15/1/2022"}, "last_audit_date: cannot convert: 15/1/2022"),
    ({"last_audit_date": "31-feb-2022"}, "last_audit_date: cannot convert: 31-feb-2022"),
    ({"last_audit_date": "2022-01-05x"}, "last_audit_date: cannot convert: 2022-01-05x"),
    ({"is_active": "maybe"}, "is_active: cannot convert: maybe"),
    ({"supplier_id": "X" * 51}, "supplier_id: too long: " + "X" * 51),
]


@pytest.mark.parametrize("cells,column,value", LOADS, ids=lambda v: str(v)[:30])
def test_cell_loads(spark, tmp_path, cells, column, value):
    row = _one(spark, tmp_path, _line(**cells))
    assert row._loaded and row._error is None
    found = row[column]
    assert (str(found) if isinstance(value, str) else found) == value


@pytest.mark.parametrize("cells,error", FAILS, ids=lambda v: str(v)[:30])
def test_cell_fails(spark, tmp_path, cells, error):
    row = _one(spark, tmp_path, _line(**cells))
    assert not row._loaded and row._error == error


def test_missing_fields_are_null_and_extra_ones_ignored(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "S1,acme\n" + _line().strip() + ",extra,more\n")
    rows = _parse(spark, tmp_path).filter("_loaded").orderBy("_source_row_number").collect()
    assert (rows[0].supplier_name, rows[0].region, rows[0].is_active) == ("acme", None, None)
    assert rows[1].is_active is True


def test_lineage_gzip_blank_lines_and_odd_names(spark, tmp_path):
    (tmp_path / "a b+c%20.v1.csv").write_text(HEADER + "\n" + _line() + "\n" + _line(supplier_id="S2"))
    with gzip.open(tmp_path / "z.csv.gz", "wt") as out:
        out.write(HEADER + _line(supplier_id="S3"))
    rows = _parse(spark, tmp_path).filter("_loaded").orderBy("supplier_id").collect()
    assert [(r.supplier_id, r._source_row_number, r._batch_id) for r in rows] == [
        ("S1", 1, "a b+c%20"), ("S2", 2, "a b+c%20"), ("S3", 1, "z")]
    assert rows[0]._source_file_name.endswith("/a b+c%20.v1.csv")
    assert {r._ingestion_status for r in rows} == {"LOADED"}


def test_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "m.csv").write_text(HEADER + _line(supplier_name='"two\nlines"') + _line(supplier_id="S2"))
    (tmp_path / "n.csv").write_text(HEADER + _line(supplier_id="S3"))
    rows = _parse(spark, tmp_path).filter("_loaded").orderBy("supplier_id").collect()
    assert [(r.supplier_id, r._source_row_number) for r in rows] == [("S1", 1), ("S2", 2), ("S3", 1)]
    assert rows[0].supplier_name == "two\nlines"


def test_line_breaks_across_splits(spark, tmp_path):
    """Records of one to four lines with commas, doubled quotes and blank lines, cut at every possible place."""
    names = ["plain", "two\nlines", 'say ""hi""\n, then\n', "a\n\n\nb", '""\n""', "x,\"\"\n,y"]
    lines = [_line(supplier_id=f"S{n:03d}", supplier_name=f'"{names[n % 6]}"', category='5" pipe') for n in range(90)]
    (tmp_path / "m.csv").write_text(HEADER + "\n".join(lines))  # with blank lines between records
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {key: spark.conf.get(key) for key in keys}
    want = [(f"S{n:03d}", n + 1, names[n % 6].replace('""', '"').strip()) for n in range(90)]
    try:
        for size in ("97", "1000000"):
            spark.conf.set(keys[0], size)
            spark.conf.set(keys[1], "1")
            rows = _parse(spark, tmp_path).filter("_loaded").orderBy("supplier_id").collect()
            assert [(r.supplier_id, r._source_row_number, r.supplier_name.strip()) for r in rows] == want
            assert {r.category for r in rows} == {'5" pipe'}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_open_quote_is_exact(spark):
    cases = {
        'a,"b': True,
        'a,"b"': False,
        'a,"b""': True,
        'a,"b"""': False,
        'a,"""': True,
        'a,""': False,
        '"x, ""y"" ,z': True,
        '5" pipe,"q"': False,
        '5" pipe,"q': True,
        'a, "b, c",  "d': True,
        '"' + '""' * 50000: True,
        '"' + '""' * 50000 + '"': False,
    }
    df = spark.createDataFrame(list(enumerate(cases)), "n int, v string")
    found = df.select("n", csv_batches.open_quote(F.col("v")).alias("o")).orderBy("n").collect()
    assert [row.o for row in found] == list(cases.values())


def test_small_splits_change_nothing(spark, tmp_path):
    lines = [_line(supplier_id=f"S{n:03d}") for n in range(200)]
    (tmp_path / "big.csv").write_text(HEADER + "".join(lines))
    whole = sorted(map(tuple, _parse(spark, tmp_path).collect()), key=repr)
    before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        parsed = _parse(spark, tmp_path)
        assert csv_batches.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 10
        assert sorted(map(tuple, parsed.collect()), key=repr) == whole
        numbers = {r.supplier_id: r._source_row_number for r in parsed.filter("_loaded").collect()}
        assert numbers == {f"S{n:03d}": n + 1 for n in range(200)}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_load_log_states(spark, tmp_path):
    (tmp_path / "all.csv").write_text(HEADER + _line())
    (tmp_path / "part.csv").write_text(HEADER + _line() + _line(is_active="?") + _line(lead_time_days="x"))
    (tmp_path / "none.csv").write_text(HEADER + _line(is_active="?"))
    (tmp_path / "empty.csv").write_text(HEADER)
    log = {r.file_name.rsplit("/", 1)[1]: r for r in load_log(_parse(spark, tmp_path), "P", _stamp()).collect()}
    assert {n: (r.load_status, r.row_count, r.error_count) for n, r in log.items()} == {
        "all.csv": ("LOADED", 1, 0),
        "part.csv": ("PARTIALLY_LOADED", 3, 2),
        "none.csv": ("LOAD_FAILED", 1, 1),
        "empty.csv": ("LOADED", 0, 0),
    }
    assert log["part.csv"].first_error == "is_active: cannot convert: ?"


def test_still_open(spark):
    cases = {"": True, "more": True, 'end"': False, 'a""b': True, 'a"",b': True, 'end",x,"again': True, 'end","y"': False}
    df = spark.createDataFrame(list(enumerate(cases)), "n int, v string")
    found = df.select("n", still_open(F.col("v")).alias("o")).orderBy("n").collect()
    assert [row.o for row in found] == list(cases.values())


def _splits_of(spark, size: str):
    """Reader settings that cut files into splits of this many bytes, undone at the end."""
    from contextlib import contextmanager

    @contextmanager
    def small():
        before = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)

    return small()


def test_names_with_pattern_characters(spark, tmp_path):
    """Files with records over several lines are not read again by name."""
    for name in ("g[1].csv", "a{b,c}.csv", "x?*.csv"):
        (tmp_path / name).write_text(HEADER + _line(supplier_id=f'"{name}"', supplier_name='"two\nlines"') + _line(supplier_id="S2"))
    rows = _parse(spark, tmp_path).filter("_loaded and supplier_id != 'S2'").collect()
    assert {(r.supplier_id, r.supplier_name, r._source_file_name.rsplit("/", 1)[1]) for r in rows} == {
        (name, "two\nlines", name) for name in ("g[1].csv", "a{b,c}.csv", "x?*.csv")}


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"], ids=["lf", "crlf", "cr"])
@pytest.mark.parametrize("size", ["61", "1000000"])
def test_line_ends_inside_quotes_stay(spark, tmp_path, end, size):
    texts = ["one", "a\nb", "a\r\nb", "a\rb", "a\n\r\n\rb", "a\r\r\nb"]
    body = "".join(_line(supplier_id=f"S{n}", supplier_name=f'"{text}"').rstrip("\n") + end + end for n, text in enumerate(texts * 4))
    (tmp_path / "m.csv").write_bytes((HEADER.rstrip("\n") + end + body).encode())
    with _splits_of(spark, size):
        rows = _parse(spark, tmp_path).filter("_loaded").orderBy("_source_row_number").collect()
    assert [(r._source_row_number, r.supplier_id, r.supplier_name) for r in rows] == [(n + 1, f"S{n}", text) for n, text in enumerate(texts * 4)]


@pytest.mark.parametrize("size", ["89", "1000000"])
def test_forgotten_quote_costs_one_line(spark, tmp_path, size):
    """All lines after it are read as if it were not there, also over many splits, and the line says what is wrong."""
    before = [_line(supplier_id=f"A{n}", supplier_name='"two\nlines"') for n in range(3)]
    after = [_line(supplier_id=f"B{n}", supplier_name='""' if n % 3 else "plain", category="") for n in range(40)]
    lines = HEADER + "".join(before) + _line(supplier_id="BAD", supplier_name='"never closed') + "\n" + "".join(after)
    (tmp_path / "m.csv").write_text(lines)
    (tmp_path / "n.csv").write_text(HEADER + _line(supplier_id="C", supplier_name='"two\nlines"') + _line(supplier_id="D"))
    with _splits_of(spark, size):
        rows = _parse(spark, tmp_path).filter("_source_row_number > 0").orderBy("_source_file_name", "_source_row_number").collect()
    assert [r.supplier_id for r in rows if r._loaded] == ["A0", "A1", "A2", *(f"B{n}" for n in range(40)), "C", "D"]
    assert [(r._source_row_number, r._error) for r in rows if not r._loaded] == [(4, csv_batches.UNCLOSED)]
    assert [r._source_row_number for r in rows] == [*range(1, 45), 1, 2]


def test_quote_forgotten_on_the_last_line(spark, tmp_path):
    (tmp_path / "m.csv").write_text(HEADER + _line() + _line(supplier_id='"S2').rstrip("\n"))
    rows = _parse(spark, tmp_path).filter("_source_row_number > 0").orderBy("_source_row_number").collect()
    assert [(r._loaded, r._error) for r in rows] == [(True, None), (False, csv_batches.UNCLOSED)]


@pytest.mark.parametrize("size", ["997", "1000000"])
def test_lines_of_a_split_are_dealt_in_runs(spark, tmp_path, monkeypatch, size):
    """However large a split is, no key of the shuffle has more lines than a run; records and a forgotten quote go over runs."""
    names = ["plain", "two\nlines", "a\n\n\n\n\n\n\n\n\n\nb"]
    lines = [_line(supplier_id=f"S{n:03d}", supplier_name=f'"{names[n % 3]}"') for n in range(60)]
    after = [_line(supplier_id=f"T{n:03d}") for n in range(20)]
    (tmp_path / "m.csv").write_text(HEADER + "\n".join(lines) + _line(supplier_id="BAD", supplier_name='"never closed') + "".join(after))
    stored, plain = {}, csv_records.materialize
    monkeypatch.setattr(csv_records, "RUN_BITS", 3, raising=False)
    monkeypatch.setattr(csv_records, "materialize", lambda df, label: stored.setdefault(label, plain(df, label)))
    with _splits_of(spark, size):
        rows = _parse(spark, tmp_path).filter("_source_row_number > 0").orderBy("_source_row_number").collect()
    assert [(r._source_row_number, r.supplier_id, r.supplier_name) for r in rows if r._loaded] == [
        *((n + 1, f"S{n:03d}", names[n % 3]) for n in range(60)), *((n + 62, f"T{n:03d}", "acme") for n in range(20))]
    assert [(r._source_row_number, r._error) for r in rows if not r._loaded] == [(61, csv_batches.UNCLOSED)]
    counts = [r["count"] for r in stored["line_states"].groupBy("_source_file_name", "_split").count().collect()]
    assert sum(counts) > 300 and max(counts) <= 8


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_are_not_shuffled_for_their_numbers(spark):
    """Offsets of 800,000 splits are broadcast by their size in bytes; beyond the limit the join shuffles."""
    number = 800_000
    splits = spark.range(number).selectExpr(
        "concat('file:///landing/a/rather/long/folder/name/of/suppliers/', id div 4) AS _source_file_name",
        "id % 4 * 134217728 AS _split", "1000L AS _rows", "id * 1000 AS _first", "false AS _open")
    rows = spark.range(10).selectExpr("concat('file:///landing/a/rather/long/folder/name/of/suppliers/', id) AS _source_file_name",
                                      "134217728L AS _split", "id AS _dense")
    from vendorium.session import materialize

    splits = materialize(splits, "many_splits")
    joined = csv_batches.with_offsets(rows, splits)
    assert "BroadcastHashJoin" in _plan(joined) and "SortMergeJoin" not in _plan(joined)
    assert csv_batches.BROADCAST_BYTES >= 800_000 * csv_batches._OFFSET_BYTES
    found = {r._source_file_name.rsplit("/", 1)[1]: r._shift for r in joined.collect()}
    assert found == {str(n): 1000 - (4 * n + 1) * 1000 for n in range(10)}

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        beyond = csv_batches.with_offsets(rows, splits, most_bytes=1000)
        assert "SortMergeJoin" in _plan(beyond)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
