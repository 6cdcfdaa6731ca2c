from __future__ import annotations

import os
import shutil
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from test_csv import HEADER, _line
from vendorium.operators import history, latest
from vendorium.plans import gold
from vendorium.sources.tables import SupplierTables
from vendorium.streaming import pipeline as jobs


class Ticking:
    """A clock that moves one minute per reading."""

    def __init__(self) -> None:
        self.now = datetime(2024, 1, 1)

    def __call__(self) -> datetime:
        self.now += timedelta(minutes=1)
        return self.now


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "landing").mkdir()
    tables = SupplierTables(spark, str(tmp_path / "tables"))
    return tables, jobs.SupplierPipeline(tables, Ticking()), tmp_path / "landing"


def _run(pipeline, landing):
    query = pipeline.start(str(landing))
    query.awaitTermination()


FIRST = HEADER + _line() + _line(supplier_id="S2") + _line(supplier_id="S3", region="") + _line(supplier_id="S4", is_active="?")
SECOND = HEADER + _line(lead_time_days="9") + _line(supplier_id="S2") + _line(supplier_id="S5") + _line(supplier_id="S5", lead_time_days="7")


def test_two_batches_then_nothing_new(place):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(FIRST)
    _run(pipeline, landing)
    (landing / "b2.csv").write_text(SECOND)
    _run(pipeline, landing)
    runs = tables.run_log().count()
    _run(pipeline, landing)  # no new file: no batch, no log row
    assert tables.run_log().count() == runs == 4

    clean = {r.supplier_id: r for r in tables.clean().collect()}
    assert {k: r.lead_time_days for k, r in clean.items()} == {"S1": 9, "S2": 5, "S5": 7}
    assert clean["S2"].load_ts < clean["S1"].load_ts == clean["S5"].load_ts
    versions = tables.dimension().orderBy("supplier_sk").collect()
    assert [(v.supplier_sk, v.supplier_id, v.is_current) for v in versions] == [
        (1, "S1", False), (2, "S2", True), (3, "S1", True), (4, "S5", True)]
    assert versions[0].valid_to == versions[2].valid_from
    assert latest.duplicate_keys(tables.clean(), "supplier_id").count() == 0
    assert latest.duplicate_keys(tables.dimension(), "supplier_sk").count() == 0
    assert history.reconcile(tables.clean(), tables.dimension()).count() == 0

    rejected = tables.rejected().collect()
    assert [(r.reject_id, r.supplier_id, r.rejection_reason) for r in rejected] == [(1, "S3", "BLANK_REGION")]
    assert [(r._source_row_number, r.error) for r in tables.load_errors().collect()] == [(4, "is_active: cannot convert: ?")]
    assert tables.raw().count() == 3 + 4

    log = tables.run_log().orderBy("run_id").collect()
    assert [(r.run_id, r.procedure_name, r.rows_processed, r.rows_inserted, r.rows_updated, r.rows_rejected) for r in log] == [
        (1, "SP_BRONZE_TO_SILVER", 3, 2, 0, 1),
        (2, "SP_SILVER_TO_GOLD", 2, 2, 0, 0),
        (3, "SP_BRONZE_TO_SILVER", 2, 2, 1, 0),
        (4, "SP_SILVER_TO_GOLD", 2, 2, 0, 0),
    ]
    assert tables.last_commit()["counts"]["superseded"] == 1
    assert [(r.log_id, r.load_status) for r in tables.load_log().orderBy("log_id").collect()] == [
        (1, "PARTIALLY_LOADED"), (2, "LOADED")]
    assert [(r.summary_id, r.total_records, r.failed_records) for r in tables.dq_summary().orderBy("summary_id").collect()] == [
        (1, 3, 1), (2, 4, 0)]
    kpi = tables.kpi_snapshot().first()
    assert (kpi.total_suppliers, kpi.active_suppliers, kpi.high_risk_count) == (3, 3, 0)
    assert tables.agg_risk_spend().first().supplier_count == 3

    before = sorted(map(tuple, tables.dimension().collect()))
    tables.vacuum()
    assert sorted(map(tuple, tables.dimension().collect())) == before


@pytest.mark.parametrize("step", ["_ingest", "_update_dimension", "_silver_to_gold"])
def test_failure_is_logged_and_replayed(place, monkeypatch, step):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(FIRST)
    _run(pipeline, landing)
    (landing / "b2.csv").write_text(SECOND)
    whole = getattr(jobs.SupplierPipeline, step)

    def breaks(self, *arguments):
        whole(self, *arguments) if step != "_silver_to_gold" else None
        raise RuntimeError("lost power")

    with monkeypatch.context() as patched:
        patched.setattr(jobs.SupplierPipeline, step, breaks)
        with pytest.raises(Exception, match="lost power"):
            _run(pipeline, landing)
    failed = tables.run_log().filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0].error_message == "lost power" and failed[0].rows_processed == 0
    assert tables.agg_risk_spend().first().supplier_count == 2  # the previous Gold is still there
    if step != "_silver_to_gold":
        assert tables.dimension().count() == 2 and tables.raw().count() == 3

    _run(pipeline, landing)
    assert tables.dimension().count() == 4 and tables.raw().count() == 7
    assert [r.supplier_sk for r in tables.dimension().orderBy("supplier_sk").collect()] == [1, 2, 3, 4]
    assert tables.agg_risk_spend().first().supplier_count == 3
    assert tables.run_log().filter("status = 'SUCCESS'").count() == 4
    assert latest.duplicate_keys(tables.run_log(), "run_id").count() == 0


def test_published_batch_is_not_run_again(place, spark):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(FIRST)
    _run(pipeline, landing)
    before = sorted(map(tuple, tables.dimension().collect()))
    lines = jobs.csv_batches.read_lines(spark, str(landing))
    assert pipeline.process(lines, 0).startswith("SUCCESS")
    assert sorted(map(tuple, tables.dimension().collect())) == before
    assert tables.run_log().count() == 2


def test_header_only_batch_is_no_data(place):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(HEADER)
    _run(pipeline, landing)
    assert tables.run_log().count() == 0 and tables.clean().count() == 0
    assert [(r.row_count, r.load_status) for r in tables.load_log().collect()] == [(0, "LOADED")]
    (landing / "b2.csv").write_text(FIRST)
    _run(pipeline, landing)
    assert tables.clean().count() == 2


def test_all_rows_rejected(place):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(HEADER + _line(region=""))
    _run(pipeline, landing)
    run = tables.run_log().orderBy("run_id").first()
    assert (run.rows_processed, run.rows_inserted, run.rows_rejected) == (1, 0, 1)
    kpi = tables.kpi_snapshot().first()
    assert (kpi.total_suppliers, kpi.active_suppliers, kpi.dq_pass_rate_pct) == (0, None, None)


def test_empty_tables_can_be_read(place):
    tables, _, _ = place
    for read in ("raw", "rejected", "current", "closed", "dimension", "clean", "load_log", "load_errors",
                 "dq_summary", "run_log", "agg_risk_spend", "kpi_snapshot"):
        assert getattr(tables, read)().count() == 0, read


def _data_files(folder):
    return sorted(p for p in folder.rglob("*.parquet"))


def test_a_batch_writes_no_unchanged_row(place):
    """Also if it delivers every supplier: one row per version opened or closed, and nothing else."""
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(HEADER + "".join(_line(supplier_id=f"S{n}") for n in range(40)))
    _run(pipeline, landing)
    (landing / "b2.csv").write_text(HEADER + "".join(_line(supplier_id=f"S{n}", lead_time_days="1" if n in (7, 9) else "5") for n in range(41)))
    _run(pipeline, landing)
    changes = tables.changes([1]).collect()
    assert sorted((r.supplier_id, r.is_current, r._was_open) for r in changes) == [
        ("S40", True, False), ("S7", False, True), ("S7", True, False), ("S9", False, True), ("S9", True, False)]
    assert tables.clean().count() == 41 and tables.clean().filter(F.col("lead_time_days") == 1).count() == 2


def test_reading_is_the_same_before_and_after_a_fold(place):
    tables, pipeline, landing = place
    reads = ("dimension", "clean", "closed", "load_log", "dq_summary", "run_log", "agg_risk_spend", "kpi_snapshot", "raw", "rejected")

    def everything():
        return {name: sorted(map(tuple, getattr(tables, name)().collect()), key=repr) for name in reads}

    assert not tables.fold()
    for number, text in enumerate((FIRST, SECOND, HEADER + _line(lead_time_days="5") + _line(supplier_id="S6"))):
        (landing / f"b{number}.csv").write_text(text)
        _run(pipeline, landing)
        before = everything()
        assert tables.fold() and everything() == before
        assert tables.last_commit()["since"] == [] and not tables.fold()
        assert tables.vacuum() > 0 and everything() == before
        assert tables.vacuum() == 0
    assert [r.run_id for r in tables.run_log().orderBy("run_id").collect()] == [1, 2, 3, 4, 5, 6]
    assert history.reconcile(tables.clean(), tables.dimension()).count() == 0


def test_files_that_a_one_row_batch_reads_and_writes(place, spark):
    """After a fold the open versions are files of id ranges; a batch for one supplier reads one and writes its change."""
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(HEADER + "".join(_line(supplier_id=f"S{n:04d}") for n in range(800)))
    _run(pipeline, landing)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.fold()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = tables.base_paths(1)
    assert len(files) == 8
    ids = spark.createDataFrame([("S0123",)], "supplier_id string")
    assert len(tables.base_paths(1, ids)) == 1
    assert {r.supplier_id for r in tables.current(ids).collect()} >= {"S0123"} and tables.current(ids).count() < 200
    assert tables.base_paths(1, ids.filter("false")) == []
    assert tables.base_paths(1, spark.createDataFrame([("A",), ("Z",)], "supplier_id string")) == []
    far = spark.createDataFrame([("S0000",), ("S0799",), ("S0799x",)], "supplier_id string")
    assert len(tables.base_paths(1, far)) == 2

    (landing / "b2.csv").write_text(HEADER + _line(supplier_id="S0123", lead_time_days="1"))
    known = set(_data_files(landing.parent / "tables" / "silver"))
    _run(pipeline, landing)
    written = [p for p in _data_files(landing.parent / "tables" / "silver") if p not in known and "dim_suppliers" in str(p)]
    assert 1 <= len(written) <= 2 and tables.changes([1]).count() == 2
    assert tables.clean().filter("lead_time_days = 1").count() == 1 and tables.clean().count() == 800


def test_many_ids_are_told_by_range(place, spark, monkeypatch):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(HEADER + "".join(_line(supplier_id=f"S{n:04d}") for n in range(300)))
    _run(pipeline, landing)
    tables.fold()
    monkeypatch.setattr("vendorium.sources.tables.MOST_IDS", 2)
    ids = spark.createDataFrame([(f"S{n:04d}",) for n in range(5)], "supplier_id string")
    found = {r.supplier_id for r in tables.current(ids).collect()}
    assert {f"S{n:04d}" for n in range(5)} <= found


def test_every_file_is_loaded_whatever_its_name_and_age(place):
    tables, pipeline, landing = place
    (landing / "UPPER.CSV").write_text(HEADER + _line(supplier_id="A"))
    _run(pipeline, landing)
    for name, supplier in (("plain.txt", "B"), ("no_suffix", "C"), ("old.csv", "D")):
        (landing / name).write_text(HEADER + _line(supplier_id=supplier))
    ten_days_ago = time.time() - 10 * 86_400
    os.utime(landing / "old.csv", (ten_days_ago, ten_days_ago))
    _run(pipeline, landing)
    assert {r.supplier_id for r in tables.clean().collect()} == {"A", "B", "C", "D"}


def test_hidden_names_are_loaded_under_their_own(place):
    """Names that the file source passes over, in folders too; what writers leave is no data."""
    tables, pipeline, landing = place
    (landing / "_sup.csv").write_text(HEADER + _line(supplier_id="A"))
    _run(pipeline, landing)
    (landing / "_dir" / "sub").mkdir(parents=True)
    (landing / "_dir" / "sub" / ".x[1] y.csv").write_text(HEADER + _line(supplier_id="B"))
    (landing / "plain").mkdir()
    (landing / "plain" / "h_odd.csv").write_text(HEADER + _line(supplier_id="C"))
    (landing / "plain" / ".dot.csv").write_text(HEADER + _line(supplier_id="D", lead_time_days="x") + _line(supplier_id="E"))
    (landing / "_SUCCESS").write_text("")
    (landing / ".b1.csv.crc").write_text("x")
    _run(pipeline, landing)
    runs = tables.run_log().count()
    _run(pipeline, landing)
    assert tables.run_log().count() == runs
    assert {r.supplier_id for r in tables.clean().collect()} == {"A", "B", "C", "E"}
    names = sorted(r.file_name.split("/landing/")[1] for r in tables.load_log().collect())
    assert names == sorted(["_sup.csv", "_dir/sub/.x[1] y.csv", "plain/h_odd.csv", "plain/.dot.csv"])
    assert {r._batch_id for r in tables.raw().filter("supplier_id = 'A'").collect()} == {"_sup"}


def test_another_checkpoint_is_refused_and_logged_or_resumed(place):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(FIRST)
    (landing / "_hidden.csv").write_text(HEADER + _line(supplier_id="H"))
    _run(pipeline, landing)
    assert tables.last_commit()["query_id"]
    shutil.rmtree(landing.parent / "tables" / "_checkpoint")
    (landing / "b2.csv").write_text(SECOND)
    with pytest.raises(Exception, match="restore its checkpoint"):
        _run(pipeline, landing)
    failed = tables.run_log().filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and "restore its checkpoint" in failed[0].error_message
    assert {r.supplier_id for r in tables.clean().collect()} == {"S1", "S2", "H"}

    pipeline.start(str(landing), resume=True).awaitTermination()
    assert {r.supplier_id for r in tables.clean().collect()} == {"S1", "S2", "S5", "H"}
    assert sorted(r.file_name.rsplit("/", 1)[1] for r in tables.load_log().collect()) == ["_hidden.csv", "b1.csv", "b2.csv"]
    assert tables.last_commit()["batch_id"] == 1 and tables.raw().count() == 3 + 1 + 4
    (landing / "b3.csv").write_text(HEADER + _line(supplier_id="S7"))
    _run(pipeline, landing)  # the new checkpoint is the tables' own now
    assert tables.last_commit()["batch_id"] == 2 and tables.clean().count() == 5
    assert latest.duplicate_keys(tables.run_log(), "run_id").count() == 0


def test_a_pattern_of_folders_and_a_missing_one(place):
    tables, pipeline, landing = place
    for name in ("a", "b"):
        (landing / name).mkdir()
        (landing / name / "x.csv").write_text(HEADER + _line(supplier_id=name))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        pipeline.start(str(landing / "nowhere")).awaitTermination()
    _run(pipeline, f"{landing}/*")
    assert {r.supplier_id for r in tables.clean().collect()} == {"a", "b"}


def _write_in_order(landing, *texts, names=None):
    """Files whose times follow the order given."""
    begun = time.time() - 1000
    for number, text in enumerate(texts):
        path = landing / (names[number] if names else f"f{number}.csv")
        path.write_text(text)
        os.utime(path, (begun + number, begun + number))


def _story(tables):
    """Each supplier's versions in order, without keys and times."""
    rows = tables.dimension().orderBy("supplier_id", "valid_from").collect()
    assert all(r.valid_to is None or r.valid_from < r.valid_to for r in rows)
    for a, b in zip(rows, rows[1:]):
        assert a.supplier_id != b.supplier_id or a.valid_to == b.valid_from
    return [(r.supplier_id, r.record_hash, r.is_current, r.source_file_name.rsplit("/", 1)[1], r.source_row_number) for r in rows]


def test_the_newest_file_wins_whatever_its_name(place):
    tables, pipeline, landing = place
    texts = [HEADER + _line(lead_time_days=str(n)) for n in (1, 2)]
    _write_in_order(landing, *texts, names=["batch_9.csv", "batch_10.csv"])
    _run(pipeline, landing)
    assert tables.clean().first().lead_time_days == 2
    assert [entry[3] for entry in _story(tables)] == ["batch_9.csv", "batch_10.csv"]


def test_one_trigger_or_one_for_each_file(spark, tmp_path):
    """The same versions, and the same numbers of versions opened and closed in all."""
    texts = []
    for number in range(7):
        rows = [_line(supplier_id=f"S{n}", lead_time_days=str((n * number // 3) % 3)) for n in range(9) if (n + number) % 4]
        texts.append(HEADER + "".join(rows) + _line(supplier_id="S0", lead_time_days="9") + _line(supplier_id="S0", lead_time_days=str(number % 2)))
    stories, sums = [], []
    for kind in ("one", "each"):
        landing = tmp_path / kind / "landing"
        landing.mkdir(parents=True)
        tables = SupplierTables(spark, str(tmp_path / kind / "tables"))
        pipeline = jobs.SupplierPipeline(tables, Ticking())
        _write_in_order(landing, *texts)
        limits = {} if kind == "one" else {"maxFilesPerTrigger": "1"}
        pipeline.start(str(landing), **limits).awaitTermination()
        runs = tables.run_log().filter("procedure_name = 'SP_BRONZE_TO_SILVER'").collect()
        assert len(runs) == (1 if kind == "one" else 7)
        sums.append(tuple(sum(r[name] for r in runs) for name in ("rows_processed", "rows_inserted", "rows_updated")))
        stories.append(_story(tables))
        rebuilt = gold.state_of(tables.current())
        assert sorted(map(tuple, rebuilt.collect()), key=repr) == sorted(map(tuple, tables.gold_state().collect()), key=repr)
    assert stories[0] == stories[1] and sums[0] == sums[1]
    assert len(stories[0]) > 20


def test_sample_files_in_one_trigger(spark, tmp_path):
    """Six files of 25 suppliers and one with 45 changed ones: 195 versions of 150 suppliers, as by seven triggers."""
    landing = tmp_path / "landing"
    landing.mkdir()
    texts = [HEADER + "".join(_line(supplier_id=f"S{n:03d}") for n in range(25 * f, 25 * f + 25)) for f in range(6)]
    texts.append(HEADER + "".join(_line(supplier_id=f"S{n:03d}", quality_score="58.739999999999995") for n in range(0, 135, 3)))
    _write_in_order(landing, *texts, names=[*(f"suppliers_batch_00{f + 1}.csv" for f in range(6)), "suppliers_updates_batch.csv"])
    tables = SupplierTables(spark, str(tmp_path / "tables"))
    jobs.SupplierPipeline(tables).start(str(landing)).awaitTermination()
    assert tables.dimension().count() == 195 and tables.clean().count() == 150 and tables.closed().count() == 45
    assert len(tables.load_log().collect()) == 7


def test_gold_is_refreshed_from_changes_alone(place, monkeypatch):
    tables, pipeline, landing = place
    third = HEADER + _line(supplier_id="S9", risk_rating="HIGH", quality_score="60", last_audit_date="2001-01-01", is_active="f") + _line(category="NULL")
    for number, text in enumerate((FIRST, SECOND, third)):
        (landing / f"b{number}.csv").write_text(text)
        if number:
            monkeypatch.setattr(tables, "clean", None)  # not read any more
        _run(pipeline, landing)
        monkeypatch.undo()
        stamp = F.lit(tables.last_commit()["run_ts"]).cast("timestamp_ntz")
        current = tables.current()
        assert sorted(map(tuple, gold.agg_risk_spend(tables.clean(), stamp).collect()), key=repr) == sorted(map(tuple, tables.agg_risk_spend().collect()), key=repr)
        whole = gold.kpi_snapshot(tables.clean(), current, stamp.cast("date"), stamp)
        assert tuple(whole.first()) == tuple(tables.kpi_snapshot().first())


def test_cadence_sees_idle_triggers_and_logs_none(place):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(FIRST)
    query = pipeline.start(str(landing), every="500 milliseconds")
    try:
        query.processAllAvailable()
        (landing / "empty.csv").write_text(HEADER)
        (landing / "_late.csv").write_text(HEADER + _line(supplier_id="L"))  # offered with the batch of the empty file
        query.processAllAvailable()
        ends = time.time() + 60
        while time.time() < ends and (pipeline.triggers.idle == 0 or tables.clean().count() < 3):
            time.sleep(0.5)
        query.processAllAvailable()
    finally:
        query.stop()
        pipeline.triggers.stop(tables.spark)
    assert pipeline.triggers.idle > 0 and pipeline.triggers.batches == 3
    log = tables.run_log().orderBy("run_id").collect()
    assert [r.procedure_name for r in log] == ["SP_BRONZE_TO_SILVER", "SP_SILVER_TO_GOLD"] * 2
    assert {r.supplier_id for r in tables.clean().collect()} == {"S1", "S2", "L"}
    assert tables.load_log().count() == 3


def test_a_run_that_was_not_logged_is_logged_on_replay(place, monkeypatch):
    tables, pipeline, landing = place
    (landing / "b1.csv").write_text(FIRST)
    with monkeypatch.context() as patched:
        patched.setattr(jobs.SupplierPipeline, "_log", lambda *_: (_ for _ in ()).throw(RuntimeError("lost power")))
        with pytest.raises(Exception, match="lost power"):
            _run(pipeline, landing)
    assert tables.last_commit()["batch_id"] == 0 and tables.run_log().count() == 0
    _run(pipeline, landing)
    assert [(r.run_id, r.procedure_name, r.rows_inserted) for r in tables.run_log().orderBy("run_id").collect()] == [
        (1, "SP_BRONZE_TO_SILVER", 2), (2, "SP_SILVER_TO_GOLD", 2)]


def test_pointers_may_be_lost_or_old(place):
    tables, pipeline, landing = place
    for number, text in enumerate((FIRST, SECOND)):
        (landing / f"b{number}.csv").write_text(text)
        _run(pipeline, landing)
    commits = landing.parent / "tables" / "_commits"
    for text in ("1", "", "x"):
        (commits / "newest-batch.txt").write_text(text)
        assert SupplierTables(tables.spark, tables.root).last_commit()["batch_id"] == 1
    (commits / "newest-batch.txt").unlink()
    (commits / "run.txt").unlink()
    assert SupplierTables(tables.spark, tables.root).last_commit()["batch_id"] == 1
    assert tables.next_run_id() == 5
