"""Vector and conversation operators against brute force, on awkward rows and on empty tables."""

from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from vendorium.llm import bit_sliced, chat, multi_index
from vendorium.llm.components import connected_components
from vendorium.llm.scratch import Scratch

VECTORS = "vec_id long, embedding array<float>, label int, n_links string"
NAN, INF = float("nan"), float("inf")


def vector_rows(seed):
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(30):
        centre = random.standard_normal(8)
        for _ in range(int(random.choice([1, 2, 6]))):
            noise = random.standard_normal(8) * random.choice([0, 0.02, 0.08])
            rows.append((len(rows), [float(x) for x in np.float32(centre + noise)], int(random.integers(0, 2)), "x"))
    at = len(rows)
    odd = [None, [], [0.0] * 8, [NAN] * 8, [INF] + [0.0] * 7, [None] + [1.0] * 7, [1.0, 2.0]]
    rows += [(at + n, vector, 1, "x") for n, vector in enumerate(odd)]
    rows += [(at + 10, rows[0][1], None, "x"), (at + 11, rows[0][1], rows[0][2], "x"), (at + 11, rows[0][1], rows[0][2], "x")]
    return rows


def test_links(spark):
    rows = vector_rows(1)
    found = multi_index.link_components(spark.createDataFrame(rows, VECTORS), recall=1.0).collect()
    usable = [(i, np.array(v, float), label) for i, v, label, _ in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links, least = dict.fromkeys(range(len(usable)), 0), [i for i, _, _ in usable]
    pairs = []
    for a, (_, x, p) in enumerate(usable):
        for b, (_, y, q) in enumerate(usable):
            if a < b and p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                pairs.append((a, b))
                links[a] += 1
                links[b] += 1
    for _ in usable:
        for a, b in pairs:
            least[a] = least[b] = min(least[a], least[b])
    expected = sorted([(i, links[n], least[n]) for n, (i, _, _) in enumerate(usable)] + [(i, 0, i) for i, v, label, _ in rows if not any(i == u for u, _, _ in usable)])
    assert len(pairs) > 30 and len(found) == len(rows)
    over = [r for r in found if r.n_links > max(n for i, n, _ in expected if i == r.vec_id)]
    assert not over
    assert sum(r.n_links for r in found) >= 0.9 * 2 * len(pairs)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert multi_index.link_components(spark.createDataFrame([], VECTORS)).collect() == []


def test_top_k(spark, monkeypatch):
    rows = vector_rows(2)
    monkeypatch.setattr(bit_sliced, "BLOCK_ROWS", 20)
    found = bit_sliced.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 3 == 0, k=4).collect()
    usable = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v, _, _ in rows if v and None not in v and np.isfinite(v).all()]
    expected = set()
    for i, x in {i: x for i, x in usable if i % 3 == 0}.items():
        best = sorted((-int(x @ y), j) for j, y in usable if j != i and len(x) == len(y))[:4]
        expected |= {(i, rank, j, -score) for rank, (score, j) in enumerate(best, start=1)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert bit_sliced.top_k(spark.createDataFrame([], VECTORS), F.lit(True)).collect() == []


def test_top_k_with_large_components(spark):
    rows = [(0, [1.0, 2.0], 1, "x"), (1, [2.0**21, 1.0], 1, "x"), (2, [-(2.0**30), 3.0], 1, "x"), (3, [0.5, 2.0**22], 1, "x"), (4, [1.0, 1.0], 1, "x"), (6, [2.0**20, -1.0], 1, "x")]
    found = bit_sliced.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 3 == 0, k=4).collect()
    whole = {i: [int(np.floor(1024 * x)) for x in v] for i, v, _, _ in rows}
    expected = set()
    for i in (0, 3, 6):
        best = sorted((-sum(a * b for a, b in zip(whole[i], y, strict=True)), j) for j, y in whole.items() if j != i)[:4]
        expected |= {(i, rank, j, -score) for rank, (score, j) in enumerate(best, start=1)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)


def test_components(spark):
    random = np.random.default_rng(4)
    edges = [(int(a), int(a) + 1) for a in range(0, 40) if a % 10 != 9] + [tuple(map(int, random.integers(100, 140, 2))) for _ in range(25)]
    least = {n: n for edge in edges if edge[0] != edge[1] for n in edge}
    for _ in range(60):
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    links = spark.createDataFrame(edges, "low long, high long")
    assert {tuple(r) for r in connected_components(links, Scratch(spark)).collect()} == set(least.items())


SCHEMAS = {"add": {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": "integer"}, "b": {"type": "array", "items": {"type": "number"}}}}}


def test_calls(spark):
    calls = [
        (1, 1, "x", "add", '{"b":[1,2.5], "a":1}'), (1, 3, "y", "add", '{"a":true}'), (1, 5, "z", "add", "no json"), (1, 5, "z", "zzz", "{}"),
        (2, 1, "x", "sub", "{}"), (2, 2, "c1", "add", '{"a":1}'), (2, 2, "c2", "add", '{"a":1,"c":2}'), (None, 1, "x", "add", "{}"), (3, 9, "late", "add", '{"a":1}'), (3, None, "n", None, None),
    ]
    results = [(1, 2, "x", "3"), (1, 4, "x", "again"), (3, 8, "late", "é"), (9, 1, "q", "lost")]
    needs = [(1, "y", "x"), (1, "z", "y"), (1, "x", "gone"), (2, "c1", "c2"), (2, "c2", "c1")]
    frames = [
        spark.createDataFrame(calls, "conv_id long, turn long, call_id string, name string, arguments string"),
        spark.createDataFrame(results, "conv_id long, turn long, call_id string, content string"),
        spark.createDataFrame(needs, "conv_id long, call_id string, needed string"),
    ]
    found = {(r.conv_id, r.call_id): r for r in chat.link_calls(*frames, SCHEMAS).collect()}
    assert {k: r.level for k, r in found.items()} == {(1, "x"): 1, (1, "y"): 2, (1, "z"): 3, (2, "x"): 1, (2, "c1"): None, (2, "c2"): None, (3, "late"): 1, (3, "n"): 1}
    assert found[1, "x"].json == '{"arguments":{"a":1,"b":[1,2.5]},"id":"x","name":"add","result":"3"}' and found[1, "x"].error is None
    assert found[1, "y"].error == "arguments.a: not of type integer" and found[1, "z"].error == "arguments: no JSON" and found[1, "z"].repeats == 1
    assert found[2, "x"].error == "unknown tool sub" and found[2, "c1"].error == "cycle" and found[2, "c2"].error == "arguments.c: not allowed"
    assert found[3, "late"].error == "result before call" and json.loads(found[3, "late"].json)["result"] == "é"
    assert chat.link_calls(*[frame.limit(0) for frame in frames], SCHEMAS).collect() == []


def test_every_row_of_conversations_comes_out(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", "a"), (1, 3, "assistant", "after a gap"), (1, 4, "assistant", "again"), (1, 5, "user", "b"), (1, 6, "tool", "t"), (1, 7, "assistant", "B"),
        (2, 0, "assistant", "hello"), (2, 1, "user", "x"), (2, 1, "user", "x y"), (2, 1, "user", "x"), (2, 2, None, "?"), (None, 1, "user", "lost"), (3, None, "user", "when"), (3, 1, "user", None),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat.link_conversations(table).collect()
    calls = {r.call_id: r for r in found if r.kind == "call"}
    result = {i: json.loads(r.json)["result"] for i, r in calls.items()}
    assert result == {"1-1": "after a gap", "1-5": "B", "2-1": None, "3-1": None}
    assert calls["1-5"].level == 2 and calls["2-1"].repeats == 2
    others = [(r.kind, r.conv_id, r.call_id, r.turn, json.loads(r.json)["text"], r.repeats) for r in found if r.kind != "call"]
    assert sorted(others, key=str) == sorted([
        ("message", 1, None, 0, "be kind", 0), ("result", 1, "1-1", 4, "again", 0), ("message", 1, None, 6, "t", 0), ("result", 2, None, 0, "hello", 0), ("repeat", 2, "2-1", 1, "x", 1),
        ("message", 2, None, 2, "?", 0), ("message", None, None, 1, "lost", 0), ("message", 3, None, None, "when", 0),
    ], key=str)
    assert sum(1 + o[5] for o in others) + len(calls) + sum(r.result_turn is not None for r in calls.values()) == len(rows)


def test_long_conversation_takes_few_turns(spark, monkeypatch):
    rows = [(7, n, "user", "q") for n in range(300)] + [(6, n, "user", "q") for n in range(3)] + [(7, 1000, "assistant", "last"), (8, 0, "assistant", "none")]
    tables, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, label: tables.append(label) or write(self, df, label))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = chat.link_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    calls = {(r.conv_id, r.turn): r for r in found if r.kind == "call"}
    assert {key: r.level for key, r in calls.items()} == {key: key[1] + 1 for key in calls} and len(calls) == 303
    assert [key for key, r in calls.items() if r.result_turn is not None] == [(7, 299)]
    assert all(json.loads(r.json)["arguments"].get("after") == (f"{r.conv_id}-{r.turn - 1}" if r.turn else None) for r in calls.values())
    assert [r.conv_id for r in found if r.kind == "result"] == [8] and len(tables) < 20


def test_levels_of_many_needs(spark):
    random = np.random.default_rng(5)
    needs = {n: {int(x) for x in random.integers(max(0, n - 9), n, random.integers(0, 4))} if n % 40 else set() for n in range(200)}
    needs[50].add(60)  # 50 and what is behind it may be on a cycle
    needs[60].add(50)
    level = {}
    while more := [n for n in needs if n not in level and all(m in level for m in needs[n])]:
        level |= {n: 1 + max((level[m] for m in needs[n]), default=0) for n in more}
    calls = spark.createDataFrame([(1, str(n)) for n in needs], "conv_id long, call_id string")
    pairs = spark.createDataFrame([(1, str(n), str(m)) for n in needs for m in needs[n]], "conv_id long, call_id string, needed string")
    found = {int(r.call_id): r.level for r in chat.call_levels(calls, pairs, Scratch(spark)).collect()}
    assert found == {n: level.get(n) for n in needs} and 0 < len(level) < 200


@pytest.mark.parametrize(("schema", "good", "bad"), [
    ({"type": ["string", "null"]}, [None, "a"], [1, True]), ({"const": 1}, [1], [True, 2]), ({"enum": [0, "a"]}, [0, "a"], [False, None]), ({"minimum": 1, "maximum": 3}, [1, 3, "a"], [0, 4]), ({"exclusiveMinimum": 1}, [1.5], [1]),
    ({"pattern": "^a"}, ["ab", 3], ["ba"]), ({"minLength": 2, "maxLength": 3}, ["ab"], ["a", "abcd"]), ({"minItems": 1, "maxItems": 2}, [[1]], [[], [1, 2, 3]]), ({"anyOf": [{"type": "string"}, {"minimum": 5}]}, ["a", 6], [4]),
    ({"oneOf": [{"minimum": 1}, {"maximum": 3}]}, [0, 4], [2]), ({"allOf": [{"minimum": 1}, {"maximum": 3}]}, [2], [0, 4]), ({"not": {"type": "null"}}, [1], [None]), ({"properties": {"a": True}, "additionalProperties": {"type": "integer"}}, [{"a": "x", "b": 1}], [{"b": "x"}]),
])
def test_schema_keywords(schema, good, bad):
    chat.refuse_unknown(schema, "tool")
    assert [value for value in good if chat.problem(value, schema)] == [] and [value for value in bad if not chat.problem(value, schema)] == []


@pytest.mark.parametrize("schema", [{"$ref": "#/x"}, {"properties": {"a": {"format": "date"}}}, {"anyOf": [{"type": "text"}]}, {"items": [{}]}, {"pattern": "("}])
def test_unknown_schema_keywords_are_refused(spark, schema):
    nothing = spark.createDataFrame([], "conv_id long, turn long, call_id string, name string, arguments string, content string, needed string")
    with pytest.raises(ValueError, match="^tool"):
        chat.link_calls(nothing, nothing, nothing, {"tool": schema})


def test_links_at_the_registered_recall(spark):
    """Planted near copies under ten labels: nearly all links that comparing all pairs finds, and no other."""
    random_ = np.random.default_rng(11)
    rows, number = [], 0
    for label in range(10):
        centres = random_.standard_normal((40, 32))
        for centre in centres:
            for _ in range(random_.integers(1, 12)):
                rows.append((number, str(label), (centre + random_.standard_normal(32) * 0.11).tolist()))
                number += 1
    found = multi_index.link_components(spark.createDataFrame(rows, "vec_id long, label string, embedding array<double>")).collect()
    units = np.array([row[2] for row in rows])
    units /= np.linalg.norm(units, axis=1)[:, None]
    labels = np.array([row[1] for row in rows])
    linked = (units @ units.T >= 0.98) & (labels[:, None] == labels)
    np.fill_diagonal(linked, False)
    wanted = linked.sum(axis=1)
    got = np.zeros(len(rows), dtype=np.int64)
    for row in found:
        got[row.vec_id] = row.n_links
    assert wanted.sum() > 1000 and (got <= wanted).all() and got.sum() >= 0.97 * wanted.sum()
    reach = np.arange(len(rows))
    for _ in range(len(rows)):
        again = np.minimum(reach, np.where(linked, reach[None, :], len(rows)).min(axis=1))
        if (again == reach).all():
            break
        reach = again
    assert np.mean([row.component_id == reach[row.vec_id] for row in found]) > 0.95
