"""Results whose order is part of the result: each row's place, not only its values, must be that of the SQL counterpart."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from compare import connect

# The columns that the order is defined by, with their directions; NULLs as the engine at hand puts them by default.
ORDERS = {
    "raw_latest": ("_load_ts DESC NULLS LAST", "_source_file_name ASC NULLS FIRST", "_source_row_number ASC NULLS FIRST"),
    "recent_runs": ("start_time DESC NULLS LAST", "run_id DESC NULLS LAST"),
    "risk_list": ("risk_level DESC NULLS LAST", "quality_score ASC NULLS FIRST"),
    "monthly_trends": ("audit_month ASC NULLS FIRST", "region ASC NULLS FIRST"),
}


def _keys(name: str) -> list[str]:
    return [spec.split()[0] for spec in ORDERS[name]]


def _wrong_places(found: list[tuple], expected: list[tuple]) -> list[int]:
    return [place for place, (own, other) in enumerate(zip(found, expected, strict=True)) if own != other]


@pytest.fixture(scope="module")
def both(spark, sf_dir):
    """For each query its sort keys row by row: as Spark returns them, and as SQL puts them."""
    database, found = connect(sf_dir), {}
    for name, order in ORDERS.items():
        rows = entry_points.queries()[name](spark, sf_dir).collect()
        sql = f"SELECT {', '.join(_keys(name))} FROM ({entry_points.oracle_sql()[name]}) ORDER BY {', '.join(order)}"
        found[name] = ([tuple(row[key] for key in _keys(name)) for row in rows], database.execute(sql).fetchall())
    return found


@pytest.mark.parametrize("name", ORDERS)
def test_order(both, name):
    found, expected = both[name]
    assert len(found) == len(expected) > 1 and _wrong_places(found, expected) == []


@pytest.mark.parametrize("name", ORDERS)
def test_a_swapped_order_is_noticed(both, name):
    found, expected = both[name]
    first = next(place for place in range(len(found) - 1) if found[place] != found[place + 1])
    swapped = [*found[:first], found[first + 1], found[first], *found[first + 2 :]]
    assert _wrong_places(swapped, expected) == [first, first + 1]
