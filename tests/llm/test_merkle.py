"""Merkle manifests against a plain loop, with the SQL counterpart on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from compare import spark_rows, sql_rows
from conftest_llm import AWKWARD, SCHEMA

from vendorium.llm import merkle


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _paths(nodes: list[str], fanout: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each node the siblings before and after on every level."""
    paths: list[list[tuple[str, str]]] = [[] for _ in nodes]
    place = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, at in enumerate(place):
            first = at // fanout * fanout
            paths[leaf].append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fanout])))
        nodes = [_hash(*nodes[at : at + fanout]) for at in range(0, len(nodes), fanout)]
        place = [at // fanout for at in place]
    return nodes[0], paths


def _fold(node: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        node = _hash(left, node, right)
    return node


def brute_force(rows: list[tuple], fanout: int) -> list[tuple]:
    """rows: doc_id, source, lang, n_chars, text."""
    groups = defaultdict(list)
    for row in rows:
        leaf = _hash(*map(_field, row))
        tampered = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
        other = _hash(*map(_field, (*row[:3], row[3] + 1, row[4]))) if tampered else leaf
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf, other))
    names = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    subroots = []
    for name in names:
        groups[name].sort()
        subroots.append(_paths([leaf for *_, leaf, _ in groups[name]], fanout))
    root, tops = _paths([subroot for subroot, _ in subroots], fanout)
    out = []
    for name, (subroot, paths), top in zip(names, subroots, tops, strict=True):
        for (known, doc, leaf, other), path in zip(groups[name], paths, strict=True):
            whole = path + top
            folded = _fold(other, whole)
            proof = _hash(*[side for step in whole for side in step])
            out.append((doc if known else None, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


LANGS = {"one": 1, "two": 2, "three": 3, None: 17, "": 16, "é": 33, "z": 64, "ä\U0001f600": 65, "many": 130}
ROWS = [(n * 3 % 70, f"s{n % 4}" if n % 5 else None, lang, n if n % 6 else None, "t" * (n % 9) if n % 8 else None) for lang, size in LANGS.items() for n in range(size)]
ROWS += [(None, None, None, None, None)] * 3 + [(7, "s", "one", 2**63 - 1, "long " * 100_000)] + [(5, "s", "two", 4, "same")] * 40


def _docs(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return docs.selectExpr("*", "'x' AS leaf", "1 AS pos", "'k' AS key", "0 AS root").repartition(5)


def _found(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.mark.parametrize("fanout,levels", [(2, 4), (3, 2), (5, 1)])
def test_against_a_plain_loop(spark, fanout, levels):
    assert _found(merkle.document_manifest(_docs(spark, ROWS), fanout, levels)) == brute_force(ROWS, fanout)


def test_single_row_and_empty_table(spark):
    one = [(1, "a", "en", 2, "x")]
    found = _found(merkle.document_manifest(_docs(spark, one)))
    assert found == brute_force(one, 2) and found[0][1] == found[0][2] == found[0][3]
    assert merkle.document_manifest(_docs(spark, ROWS).limit(0)).collect() == []


def test_many_groups(spark):
    rows = [(n, "a", f"lang{n % 300}", n, "x") for n in range(700)]
    assert _found(merkle.document_manifest(_docs(spark, rows))) == brute_force(rows, 2)


def test_sql_counterpart_on_awkward_rows(spark, awkward, tmp_path):
    awkward.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = spark_rows(merkle.query(spark, str(tmp_path)))
    assert found == sql_rows(connection, merkle.ORACLE_SQL)
    assert len(found[1]) == len(AWKWARD) and SCHEMA.names


def test_equal_rows_do_not_meet_in_one_range(spark):
    """Rows alike in every column are dealt over several ranges."""
    from vendorium.llm.scratch import Scratch

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        same = spark.range(0, 20_000, 1, 4).selectExpr("'' AS key", "1 AS order", "'n' AS node")
        placed = merkle._placed(same, ["order", "node"], 2, Scratch(spark), "equal")
        assert sorted(row.pos for row in placed.select("pos").collect()) == list(range(20_000))
        largest = max(row["count"] for row in placed.groupBy(merkle.F.spark_partition_id()).count().collect())
        assert largest < 8_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
