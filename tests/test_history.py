from __future__ import annotations

import random

from pyspark.sql import functions as F, types as T

from samples import batch_time, raw_rows
from vendorium.operators import history, latest
from vendorium.operators.routing import accepted, flag
from vendorium.schemas import DIM_SUPPLIERS, SUPPLIERS_CLEAN

DIM = T.StructType([field for field in DIM_SUPPLIERS if field.name != "supplier_sk"])


def _stamp(number: int):
    return F.lit(str(batch_time(number))).cast("timestamp_ntz")


def _deliveries(spark, batches: list[list[dict]]):
    """Deduplicated deliveries of all batches, and the list of them by batch."""
    parts = [
        latest.latest_per_key(accepted(flag(raw_rows(spark, *rows, batch=number))))
        for number, rows in enumerate(batches, start=1)
    ]
    everything = parts[0]
    for part in parts[1:]:
        everything = everything.unionByName(part)
    return everything, parts


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def _folded(spark, parts):
    dimension, clean = spark.createDataFrame([], DIM), spark.createDataFrame([], SUPPLIERS_CLEAN)
    for number, part in enumerate(parts, start=1):
        dimension = history.fold(dimension, part, _stamp(number))
        clean = history.upsert(clean, part, _stamp(number))
    return dimension, clean


def test_last_row_of_a_batch_wins(spark):
    rows = raw_rows(spark, {"lead_time_days": 1}, {"lead_time_days": 2}, {"lead_time_days": 3, "region": ""})
    kept = latest.latest_per_key(accepted(flag(rows))).collect()
    assert [row.lead_time_days for row in kept] == [2]  # the third was rejected


def test_value_that_returns_opens_three_versions(spark):
    batches = [[{"lead_time_days": n}] for n in (1, 2, 1)]
    everything, _ = _deliveries(spark, batches)
    versions = history.rebuild(everything).orderBy("valid_from").collect()
    assert [v.lead_time_days for v in versions] == [1, 2, 1]
    assert [v.valid_to for v in versions] == [batch_time(2), batch_time(3), None]
    assert [v.is_current for v in versions] == [False, False, True]


def test_unchanged_delivery_keeps_the_old_row(spark):
    everything, parts = _deliveries(spark, [[{}], [{}]])
    dimension, clean = _folded(spark, parts)
    assert dimension.count() == history.rebuild(everything).count() == 1
    assert clean.first().load_ts == batch_time(1)
    assert clean.first().source_file_name == "raw/b1.csv"


def test_absent_supplier_stays_current(spark):
    everything, _ = _deliveries(spark, [[{"supplier_id": "A"}], [{"supplier_id": "B"}]])
    assert history.clean_state(history.rebuild(everything)).count() == 2


def test_fold_equals_rebuild_on_random_batches(spark):
    chance = random.Random(7)
    batches = [
        [
            {"supplier_id": f"S{chance.randrange(12)}", "lead_time_days": chance.randrange(3)}
            for _ in range(15)
        ]
        for _ in range(5)
    ]
    everything, parts = _deliveries(spark, batches)
    rebuilt = history.rebuild(everything).cache()
    dimension, clean = _folded(spark, parts)
    assert _rows(dimension) == _rows(rebuilt)
    assert _rows(clean) == _rows(history.clean_state(rebuilt))
    assert history.reconcile(clean, rebuilt).count() == 0

    by_supplier: dict[str, list] = {}
    for version in rebuilt.orderBy("valid_from").collect():
        by_supplier.setdefault(version.supplier_id, []).append(version)
    for versions in by_supplier.values():
        assert sum(v.is_current for v in versions) == 1 and versions[-1].is_current
        assert all(a.valid_to == b.valid_from for a, b in zip(versions, versions[1:]))
        assert all(a.record_hash != b.record_hash for a, b in zip(versions, versions[1:]))


def test_replay_of_a_batch_changes_nothing(spark):
    _, parts = _deliveries(spark, [[{}, {"supplier_id": "S2"}]])
    once = history.fold(spark.createDataFrame([], DIM), parts[0], _stamp(1))
    twice = history.fold(once, parts[0], _stamp(2))
    assert _rows(once) == _rows(twice)


def test_changed_and_without_current_select_keys(spark):
    def state(*pairs):
        return spark.createDataFrame(pairs, "supplier_id string, record_hash string")

    current, clean = state(("A", "1"), ("B", "1")), state(("A", "1"), ("B", "2"), ("C", "1"))
    expired = history.changed(current, clean)
    assert [row.supplier_id for row in expired.collect()] == ["B"]
    remaining = current.join(expired, "supplier_id", "left_anti")
    opened = history.without_current(clean, remaining)
    assert sorted(row.supplier_id for row in opened.collect()) == ["B", "C"]


def test_reconcile_reports_both_sides(spark):
    clean = spark.createDataFrame([("A", "1"), ("B", "1")], "supplier_id string, record_hash string")
    dim = spark.createDataFrame([("A", "2", True), ("C", "1", True), ("B", "1", True)],
                                "supplier_id string, record_hash string, is_current boolean")
    assert sorted(row.supplier_id for row in history.reconcile(clean, dim).collect()) == ["A", "C"]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "k string")
    assert [tuple(row) for row in latest.duplicate_keys(df, "k").collect()] == [("A", 2)]
