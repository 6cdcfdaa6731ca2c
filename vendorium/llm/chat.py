"""Tool calls in conversations: link results, order, validate and serialise."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from vendorium.llm.scratch import Scratch
from vendorium.llm.shipping import ship

_KINDS: dict[str, tuple[type, ...]] = {"string": (str,), "integer": (int,), "number": (int, float), "boolean": (bool,), "object": (dict,), "array": (list,), "null": (type(None),)}


def canonical(value: Any) -> str:
    """One text for equal values: keys in code point order, no spaces, no escapes but the needed ones."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _refused(constant: str) -> None:
    raise ValueError(f"{constant} is no JSON")


def _finite(digits: str) -> float:
    number = float(digits)
    if math.isinf(number):
        _refused(digits)
    return number


def parsed(text: str) -> Any:
    """A JSON value that can be written as UTF-8 JSON again. ValueError for anything else: no JSON, NaN and infinite
    numbers, lone surrogates, and values nested too deeply to be read."""
    try:
        value = json.loads(text, parse_constant=_refused, parse_float=_finite)
        canonical(value).encode("utf-8")
    except RecursionError:
        raise ValueError("nested too deeply") from None
    return value


_LIMITS = ("minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "minItems", "maxItems")
_CHECKED = {"type", "enum", "const", "required", "properties", "additionalProperties", "items", "pattern", "anyOf", "oneOf", "allOf", "not", *_LIMITS}
_NOTES = {"title", "description", "default", "examples", "deprecated", "readOnly", "writeOnly", "$schema", "$id", "$comment"}


def refuse_unknown(schema: Any, path: str) -> None:
    """Raise ValueError where a schema holds what `problem` does not check, such as `$ref` or `format`."""
    if isinstance(schema, bool):
        return
    if not isinstance(schema, dict):
        raise ValueError(f"{path}: no schema")
    if unknown := sorted(set(schema) - _CHECKED - _NOTES):
        raise ValueError(f"{path}: {', '.join(unknown)} cannot be checked")
    kinds = schema.get("type", [])
    if unknown := [kind for kind in ([kinds] if isinstance(kinds, str) else kinds) if kind not in _KINDS]:
        raise ValueError(f"{path}: unknown type {unknown[0]}")
    if "pattern" in schema:
        try:
            re.compile(schema["pattern"])
        except re.error as wrong:
            raise ValueError(f"{path}: pattern: {wrong}") from wrong
    for name, inner in schema.get("properties", {}).items():
        refuse_unknown(inner, f"{path}.{name}")
    for word in ("anyOf", "oneOf", "allOf"):
        for place, inner in enumerate(schema.get(word, ())):
            refuse_unknown(inner, f"{path}.{word}[{place}]")
    for word in ("additionalProperties", "items", "not"):
        if word in schema:
            refuse_unknown(schema[word], f"{path}.{word}")


def _same(a: Any, b: Any) -> bool:
    """Equality of JSON values: true is not 1."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[name], b[name]) for name in a)
    return a == b


def _beyond(value: Any, schema: dict) -> str | None:
    """The limit that a number, text or list breaks."""
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        measures = {"minimum": lambda x: value >= x, "maximum": lambda x: value <= x, "exclusiveMinimum": lambda x: value > x, "exclusiveMaximum": lambda x: value < x}
    elif isinstance(value, str):
        measures = {"minLength": lambda x: len(value) >= x, "maxLength": lambda x: len(value) <= x}
    elif isinstance(value, list):
        measures = {"minItems": lambda x: len(value) >= x, "maxItems": lambda x: len(value) <= x}
    else:
        measures = {}
    return next((word for word, holds in measures.items() if word in schema and not holds(schema[word])), None)


def problem(value: Any, schema: dict | bool, path: str = "$") -> str | None:
    """What first breaks the schema; it may hold the keywords in `_CHECKED` (see `refuse_unknown`)."""
    if isinstance(schema, bool):
        return None if schema else f"{path}: not allowed"
    if (kinds := schema.get("type")) is not None:
        listed = [kinds] if isinstance(kinds, str) else kinds
        if not any(isinstance(value, _KINDS[kind]) and not (isinstance(value, bool) and kind in ("integer", "number")) for kind in listed):
            return f"{path}: not of type {' or '.join(listed)}"
    if "enum" in schema and not any(_same(value, one) for one in schema["enum"]):
        return f"{path}: not one of the values"
    if "const" in schema and not _same(value, schema["const"]):
        return f"{path}: not the value"
    if broken := _beyond(value, schema):
        return f"{path}: against {broken} {schema[broken]}"
    if "pattern" in schema and isinstance(value, str) and not re.search(schema["pattern"], value):
        return f"{path}: against pattern {schema['pattern']}"
    for inner in schema.get("allOf", ()):
        if found := problem(value, inner, path):
            return found
    if "anyOf" in schema and all(problem(value, inner, path) for inner in schema["anyOf"]):
        return f"{path}: fits none of anyOf"
    if "oneOf" in schema and sum(problem(value, inner, path) is None for inner in schema["oneOf"]) != 1:
        return f"{path}: fits not one of oneOf"
    if "not" in schema and problem(value, schema["not"], path) is None:
        return f"{path}: fits what it must not"
    if isinstance(value, dict):
        for name in sorted(schema.get("required", ())):
            if name not in value:
                return f"{path}.{name}: missing"
        known = schema.get("properties", {})
        for name in sorted(value):
            if found := problem(value[name], known.get(name, schema.get("additionalProperties", True)), f"{path}.{name}"):
                return found
    if isinstance(value, list) and "items" in schema:
        for place, item in enumerate(value):
            if found := problem(item, schema["items"], f"{path}[{place}]"):
                return found
    return None


def call_levels(calls: DataFrame, needs: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, call_id, level): 1 for calls that need no other, else one more than the highest they need.

    Sorting by level, then by anything, is a topological order. Calls on a cycle, or behind one, never settle: null.
    Needs for calls that do not exist are ignored.

    One table holds a row for each call: its open needs, each with the distance to it, and the level that it has at
    least. In each turn a need of a settled call is done, and a need of a call with a single open need is passed on
    to that one, so distances double and turns grow with the logarithm of a chain. Only calls with several open needs
    that do not come down to one are waited for: where such calls build on each other, turns grow with their number.
    A call all of whose needs are settled settles in the next turn, so a turn that settles none is the last.
    """
    keys = ["conv_id", "call_id"]
    distinct = calls.select(*keys).distinct()
    existing = distinct.withColumnsRenamed({"call_id": "needed"})
    needs = needs.select(*keys, "needed").distinct().join(existing, ["conv_id", "needed"], "left_semi")
    needs = needs.groupBy(*keys).agg(F.collect_list(F.struct("needed", F.lit(1).alias("ahead"))).alias("needs"))
    none = F.array().cast("array<struct<needed:string,ahead:int>>")
    state = distinct.join(needs, keys, "left").select(*keys, F.lit(1).alias("least"), F.coalesce("needs", none).alias("needs"))
    state = scratch.write(state, "levels-0")
    turn, before = 0, state.filter("size(needs) > 0").count()
    while before:
        turn += 1
        open_ = state.filter("size(needs) > 0")
        each = open_.select(*keys, F.explode("needs").alias("need")).select(*keys, "need.*")
        single = F.when(F.size("needs") == 1, F.col("needs")[0])
        known = state.select("conv_id", F.col("call_id").alias("needed"), F.col("least").alias("known"), F.size("needs").alias("open"), single.alias("next"))
        # What a call with several open needs has at least it gets to know when they are done, so that is not passed on.
        gained = F.when(F.col("open") < 2, F.col("known") + F.col("ahead"))
        target = F.when(F.col("open") == 1, F.struct(F.col("next.needed").alias("needed"), (F.col("next.ahead") + F.col("ahead")).alias("ahead"))).when(F.col("open") > 1, F.struct("needed", "ahead"))
        moved = each.join(known, ["conv_id", "needed"]).select(*keys, gained.alias("gained"), target.alias("target"))
        moved = moved.repartition(*keys).groupBy(*keys, F.col("target.needed").alias("needed")).agg(F.max("gained").alias("gained"), F.max("target.ahead").alias("ahead"))
        left = F.collect_list(F.when(F.col("needed").isNotNull(), F.struct("needed", "ahead")))
        moved = moved.groupBy(*keys).agg(F.max("gained").alias("gained"), left.alias("left"))
        stepped = open_.join(moved, keys).select(*keys, F.greatest("least", "gained").alias("least"), F.col("left").alias("needs"))
        state = scratch.write(state.filter("size(needs) = 0").unionByName(stepped), f"levels-{turn}")
        scratch.drop(f"levels-{turn - 1}")
        waiting = state.filter("size(needs) > 0").count()
        if waiting == before:
            break
        before = waiting
    return state.select(*keys, F.when(F.size("needs") == 0, F.col("least")).alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, needs: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call, in a canonical form.

    calls: conv_id, turn, call_id, name, arguments (JSON text); results: conv_id, turn, call_id, content; needs:
    conv_id, call_id, needed. A result belongs to the call with its conv_id and call_id; of several the one of the
    earliest turn, then the smallest content. A call id that comes twice is one call, that of its earliest turn, then
    smallest name and arguments; `repeats` counts the others. Rows without conv_id or call_id take no part. Returns
    conv_id, call_id, turn, level (see `call_levels`), result_turn, repeats, error and json; error names the first
    fault (unknown tool, arguments that are no JSON or break the schema, a cycle, a result before its call) and is
    null for good calls; a call without result has a null result. Output order is level, turn, call_id. Raises
    ValueError for a schema with keywords that are not checked.
    """
    for name, schema in schemas.items():
        refuse_unknown(schema, name)
    ship(calls.sparkSession)
    scratch = Scratch(calls.sparkSession)
    keys = ["conv_id", "call_id"]
    there = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one = calls.filter(there).groupBy(*keys).agg(F.min(F.struct("turn", "name", "arguments")).alias("call"), (F.count("*") - 1).alias("repeats"))
    one = scratch.write(one.select(*keys, "call.*", "repeats"), "calls")
    answers = results.filter(there).groupBy(*keys).agg(F.min(F.struct("turn", "content")).alias("result"))
    answers = answers.select(*keys, F.col("result.turn").alias("result_turn"), "result.content")
    levels = call_levels(one, needs.filter(there & F.col("needed").isNotNull()), scratch)
    linked = one.join(answers, keys, "left").join(levels, keys, "left")

    @F.pandas_udf("error string, json string")
    def finish(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for call_id, name, arguments, content, level, turn, result_turn in zip(*batch, strict=True):
                error, value = None, None
                try:
                    value = parsed(arguments) if arguments is not None else {}
                    error = problem(value, schemas[name], "arguments") if name in schemas else f"unknown tool {name}"
                except ValueError:
                    error, value = "arguments: no JSON", arguments
                except RecursionError:  # read, but too deep to be checked
                    error, value = "arguments: nested too deeply", arguments
                if error is None and pd.isna(level):
                    error = "cycle"
                if error is None and not pd.isna(result_turn) and not pd.isna(turn) and result_turn < turn:
                    error = "result before call"
                rows.append((error, canonical({"id": call_id, "name": name, "arguments": value, "result": content})))
            yield pd.DataFrame(rows, columns=["error", "json"])

    done = finish("call_id", "name", "arguments", "content", "level", "turn", "result_turn").alias("done")
    return linked.select(*keys, "turn", "level", "result_turn", "repeats", done).select(*keys, "turn", "level", "result_turn", "repeats", "done.*")


# What each reply in a conversation amounts to as a call: the request, and the reply before that it builds on.
REPLY_SCHEMA = {"reply": {"type": "object", "required": ["text", "turn"], "additionalProperties": False, "properties": {"text": {"type": "string"}, "turn": {"type": "integer"}, "after": {"type": "string"}}}}


def _last_asked(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, turn, before): for each turn the last one before it, in its conversation, that has a user's row.

    Turns are cut into ranges of (conv_id, turn) and looked through in each by itself, so no task reads a long
    conversation whole. What comes before a range is the last user's turn of the ranges before it; the driver gets one
    row for each range.
    """
    distinct = turns.groupBy("conv_id", "turn").agg(F.coalesce(F.bool_or(F.col("role") == "user"), F.lit(False)).alias("asked"))
    parts = scratch.write(distinct.repartitionByRange("conv_id", "turn").withColumn("part", F.spark_partition_id()), "turn-ranges")
    lasts = parts.groupBy("part").agg(F.max(F.when(F.col("asked"), F.struct("conv_id", "turn"))).alias("last"))
    carried, last = [], None
    for row in sorted(lasts.collect()):
        carried.append((row.part, *(last or (None, None))))
        last = row["last"] or last
    carried = turns.sparkSession.createDataFrame(carried, "part int, last_conv long, last_turn long")
    ahead = Window.partitionBy("part", "conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    within = parts.withColumn("within", F.max(F.when(F.col("asked"), F.col("turn"))).over(ahead))
    earlier = F.when(F.col("last_conv") == F.col("conv_id"), F.col("last_turn"))
    found = within.join(F.broadcast(carried), "part").select("conv_id", "turn", F.coalesce("within", earlier).alias("before"))
    found = scratch.write(found, "last-asked")
    scratch.drop("turn-ranges")
    return found


def _typed(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


_PLACED = "conv_id is not null and turn is not null"


def reply_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calls, results and needs from plain conversations: a user's row asks, assistant's rows answer the last user's
    turn before them. Assistant's rows with no such turn have a null call_id."""
    turns = _typed(conversations).filter(_PLACED)
    before = _last_asked(turns, Scratch(conversations.sparkSession))
    name = lambda turn: F.concat_ws("-", F.col("conv_id").cast("string"), turn.cast("string"))
    previous = F.when(F.col("before").isNotNull(), name(F.col("before")))
    asked = turns.filter("role = 'user'").join(before, ["conv_id", "turn"])
    arguments = F.to_json(F.struct("text", "turn", previous.alias("after")))
    calls = asked.select("conv_id", "turn", name(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"))
    needs = before.join(turns.filter("role = 'user'").select("conv_id", "turn"), ["conv_id", "turn"], "left_semi")
    needs = needs.filter("before is not null").select("conv_id", name(F.col("turn")).alias("call_id"), name(F.col("before")).alias("needed"))
    said = turns.filter("role = 'assistant'").join(before, ["conv_id", "turn"])
    results = said.select("conv_id", "turn", previous.alias("call_id"), F.col("text").alias("content"))
    return calls, results, needs


def _further(rows: DataFrame, content: str) -> DataFrame:
    """Of rows (conv_id, call_id, turn, content) all but the one of each call that `link_calls` takes, equal rows as
    one with their number as `copies`."""
    keys = ["conv_id", "call_id"]
    several = rows.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1").select(*keys)
    each = rows.join(several, keys, "left_semi").groupBy(*keys, "turn", content).agg(F.count("*").alias("copies"))
    taken = each.groupBy(*keys).agg(F.min(F.struct("turn", content)).alias("taken"))
    same = F.col("turn").eqNullSafe(F.col("taken.turn")) & F.col(content).eqNullSafe(F.col(f"taken.{content}"))
    left = each.join(taken, keys).withColumn("copies", F.col("copies") - same.cast("long"))
    return left.filter("copies > 0").select(*keys, "turn", content, "copies")


def other_rows(conversations: DataFrame, calls: DataFrame, results: DataFrame) -> DataFrame:
    """The rows of conversations that are neither the call nor the result in a row of `link_calls`, by `kind`:

    `repeat`, another user's row of a call's turn; `result`, an assistant's row after a call that has an earlier result,
    or (call_id null) after none; `message`, a row of another role, or without conv_id, turn or role. Columns are those
    of `link_calls`; json has role and text, and `repeats` counts further equal repeats or results.
    """
    ship(conversations.sparkSession)
    turns = _typed(conversations)
    message = turns.filter(~(F.expr(_PLACED) & F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))))
    nothing, once = F.lit(None).cast("string").alias("call_id"), F.lit(1).cast("long").alias("copies")
    text = F.from_json("arguments", "text string")["text"].alias("text")
    whole = message.select("conv_id", nothing, "turn", "role", "text", once, F.lit("message").alias("kind"))
    result = [results.filter("call_id is null").withColumn("copies", once), _further(results.filter("call_id is not null"), "content")]
    for rows in result:
        whole = whole.unionByName(rows.select("conv_id", "call_id", "turn", F.lit("assistant").alias("role"), F.col("content").alias("text"), "copies", F.lit("result").alias("kind")))
    whole = whole.unionByName(_further(calls, "arguments").select("conv_id", "call_id", "turn", F.lit("user").alias("role"), text, "copies", F.lit("repeat").alias("kind")))

    @F.pandas_udf("string")
    def written(role: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([canonical({"role": r, "text": t}) for r, t in zip(role, text, strict=True)], dtype=object)

    null = lambda kind: F.lit(None).cast(kind)
    return whole.select("conv_id", "call_id", "turn", null("int").alias("level"), null("long").alias("result_turn"), (F.col("copies") - 1).alias("repeats"), null("string").alias("error"), written("role", "text").alias("json"), "kind")


def link_conversations(conversations: DataFrame) -> DataFrame:
    """Every row of conversations: as a call, as the result in a call's row, or as a row of `other_rows`."""
    calls, results, needs = reply_calls(conversations)
    linked = link_calls(calls, results, needs, REPLY_SCHEMA).withColumn("kind", F.lit("call"))
    return linked.unionByName(other_rows(conversations, calls, results))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
