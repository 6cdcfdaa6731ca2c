"""Records of CSV files whose quoted fields run over line ends, put together from lines in parallel.

Whether a line starts inside quotes depends on all lines before it in the file. But a line can
only do four things to that state: set it to either value, keep it, or turn it over. The state
before a line is thus the last one set, turned over as often as lines turned it since. That is
a running total, taken over the lines of each split and then over the splits of each file.

A quote that is open at the end of a file was opened by the last line that opened one. That line is a record of its own
then, and all lines after it are taken from outside quotes: none of them can open another one, or it would have closed
the first. So a forgotten quote costs a line and never gathers the rest of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from vendorium.session import materialize

# A quoted field that closes on its line, from the start of the field to the next comma.
CLOSED_FIELD = r'(^|,)[ \t]*+"[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+'
# The rest of a quoted field that began on an earlier line, likewise.
CLOSING_PART = r'^[^"]*+(?:""[^"]*+)*+"(?!")[^,]*+'

FILE = "_source_file_name"
PLACE = (FILE, "_split", "_place")
RUN_BITS = 16  # lines are dealt to tasks in runs of 2**16 places at most


def open_quote(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside them.

    Closed quoted fields are taken out first; a quote left at the start of a field is open.
    If no line of a file is open, then by induction every line of it starts outside quotes.
    """
    found = F.regexp_replace(line, CLOSED_FIELD, "$1").rlike(r'(^|,)[ \t]*"')
    return F.when(F.contains(line, F.lit('"')), found).otherwise(False)


def still_open(line: Column) -> Column:
    """Whether a line that starts inside quotes ends inside them."""
    found = ~line.rlike(CLOSING_PART) | open_quote(F.regexp_replace(line, CLOSING_PART, ""))
    return F.when(F.contains(line, F.lit('"')), found).otherwise(True)


def _turned(state: Column, times: Column) -> Column:
    return state != (times % 2 == 1)


def _state_before(df: DataFrame, after_out: str, after_in: str, *partition: str, order: str) -> DataFrame:
    """Add `_before_out` and `_before_in`: the state before each row if the partition starts outside or inside."""
    earlier = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col(after_out) == F.col(after_in)
    turns = F.col(after_out) & ~F.col(after_in)
    counted = df.withColumn("_turns", F.coalesce(F.sum(turns.cast("int")).over(earlier), F.lit(0)))
    last_set = F.when(sets, F.struct(F.col(after_out).alias("state"), F.col("_turns").alias("turns")))
    anchored = counted.withColumn("_set", F.last(last_set, ignorenulls=True).over(earlier))
    since = _turned(F.col("_set.state"), F.col("_turns") - F.col("_set.turns"))

    def before(start: bool) -> Column:
        return F.when(F.col("_set").isNull(), _turned(F.lit(start), F.col("_turns"))).otherwise(since)

    return anchored.withColumns({"_before_out": before(False), "_before_in": before(True)}).drop("_turns", "_set")


def _numbered(df: DataFrame) -> DataFrame:
    """Add `_n_out` and `_n_in`, the records begun up to a line if its split starts outside or inside quotes, and `_n_all`,
    its lines that are not blank: as many records, once no line is inside quotes any more."""
    so_far = Window.partitionBy(FILE, "_split").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    filled = ~F.col("_blank")

    def total(condition: Column) -> Column:
        return F.sum(condition.cast("long")).over(so_far)

    return df.withColumns({
        "_n_out": total(filled & ~F.col("_before_out")), "_n_in": total(filled & ~F.col("_before_in")), "_n_all": total(filled)
    })


def _after(before: str) -> Column:
    return F.when(F.col(before), F.col("_in")).otherwise(F.col("_out"))


def _entered(stated: DataFrame) -> DataFrame:
    """One row per split: the state it is entered in, the one it is left in, its records and lines, and its last line that
    opens a quote, with the records and lines up to it."""

    def opening(start: str) -> Column:
        line = F.struct("_place", F.col(f"_n_{start}").alias("records"), F.col("_n_all").alias("lines"))
        return F.max(F.when(~F.col(f"_before_{start}") & F.col("_out"), line))

    per_split = stated.groupBy(FILE, "_split").agg(
        F.max_by(_after("_before_out"), "_place").alias("_split_out"),
        F.max_by(_after("_before_in"), "_place").alias("_split_in"),
        opening("out").alias("_opens_out"),
        opening("in").alias("_opens_in"),
        *[F.max(name).alias(name) for name in ("_n_out", "_n_in", "_n_all")],
    )
    entered = _state_before(per_split, "_split_out", "_split_in", FILE, order="_split")
    inside = F.col("_before_out")  # a file starts outside

    def either(name: str) -> Column:
        return F.when(inside, F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))

    return entered.select(
        FILE, "_split", inside.alias("_inside"), either("_split").alias("_left_inside"), either("_opens").alias("_opens"),
        either("_n").alias("_records"), F.col("_n_all").alias("_lines"),
    )


def _forgotten(entered: DataFrame) -> DataFrame:
    """For each file that ends inside quotes, the line that opened them."""
    last = F.max(F.when(F.col("_opens").isNotNull(), F.struct("_split", "_opens")))
    per_file = entered.groupBy(FILE).agg(F.max_by("_left_inside", "_split").alias("_open_end"), last.alias("_last"))
    return per_file.filter("_open_end").select(FILE, F.struct("_last._split", "_last._opens.*").alias("_at"))


def _whole(parts: Column) -> Column:
    """Lines with the ends between them."""
    ended = F.transform(parts, lambda part, n: F.concat(part["value"], F.when(n < F.size(parts) - 1, part["_end"]).otherwise("")))
    return F.array_join(ended, "")


def _split_records(entered: DataFrame) -> DataFrame:
    """For each split its state, the file's forgotten quote, and the records before it."""
    known = entered.join(_forgotten(entered), FILE, "left")
    rest = F.col("_at.records") + F.col("_lines") - F.col("_at.lines")
    own = F.when(F.col("_split") > F.col("_at._split"), F.col("_lines")).when(F.col("_split") == F.col("_at._split"), rest)
    earlier = Window.partitionBy(FILE).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.coalesce(own, F.col("_records"))).over(earlier), F.lit(0))
    return known.select(FILE, "_split", "_inside", "_at", before.alias("_earlier"))


def joined_records(lines: DataFrame) -> DataFrame:
    """Whole records as `value`, with file, its time and record number, the header being 0.

    `lines` has every line with its place and its `_end`, blank ones too. Those outside quotes are dropped; line ends
    inside quotes stay what they were. `_unclosed` marks a record whose quote is never closed.

    Lines are shuffled once, to their run: so many places of a split. Few splits would lie unevenly on the tasks, and one of
    a file that no reader can split would be one task. From here on a run is what `_split` means; runs have the
    order of the splits and, within one, of the places. Only records of several lines are then put together, by another
    shuffle.
    """
    runs = lines.withColumn("_split", F.struct("_split", F.shiftright("_place", RUN_BITS).alias("_run")))
    marked = runs.withColumns({"_out": open_quote(F.col("value")), "_in": still_open(F.col("value"))})
    stated = _numbered(_state_before(marked, "_out", "_in", FILE, "_split", order="_place"))
    stated = materialize(stated, "line_states")
    entered = materialize(_entered(stated), "split_states")
    splits = materialize(_split_records(entered), "split_records")

    state = F.when(F.col("_inside"), F.col("_before_in")).otherwise(F.col("_before_out"))
    same = F.col("_split") == F.col("_at._split")
    later = F.coalesce((F.col("_split") > F.col("_at._split")) | (same & (F.col("_place") > F.col("_at._place"))), F.lit(False))
    rest = F.when(same, F.col("_at.records") - F.col("_at.lines")).otherwise(0) + F.col("_n_all")
    begun = F.when(later, rest).when(F.col("_inside"), F.col("_n_in")).otherwise(F.col("_n_out"))
    known = stated.join(splits, [FILE, "_split"]).select(
        "value", "_end", "_blank", "_out", FILE, "_split", "_place", "_file_time",
        (state & ~later).alias("_state"),
        F.coalesce(same & (F.col("_place") == F.col("_at._place")), F.lit(False)).alias("_unclosed"),
        (F.col("_earlier") + begun - 1).cast("long").alias("_source_row_number"),
    )
    known = known.filter(F.col("_state") | ~F.col("_blank"))
    alone = ~F.col("_state") & ~F.col("_out")
    columns = (FILE, "_source_row_number", "_file_time", "_unclosed", "value")
    parts = F.array_sort(F.collect_list(F.struct("_split", "_place", "value", "_end")))
    together = (
        known.filter(~alone)
        .groupBy(FILE, "_source_row_number")
        .agg(F.max("_file_time").alias("_file_time"), F.max("_unclosed").alias("_unclosed"), parts.alias("_parts"))
        .withColumn("value", _whole(F.col("_parts")))
    )
    return known.filter(alone).select(*columns).unionByName(together.select(*columns))
