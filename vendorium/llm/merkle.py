"""Merkle manifest of a table: leaves, subroots, root, and for each row the siblings that prove it.

Slot pivot: conditional aggregates spread the children of a node into columns, one for each slot. The columns of a run
put together and hashed give the parent; the columns of a run without the own one are the siblings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vendorium.llm.scratch import Scratch

FANOUT = 2
LEVELS = 4  # levels that one grouping builds: it spreads FANOUT ** LEVELS nodes into columns
TAMPERED_OF = 7  # the query tampers with rows whose crc32(doc_id) this number divides
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_LOCAL_BITS = 33  # `monotonically_increasing_id` has the place in the partition in the low 33 bits

_PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of texts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value so that neighbours cannot run into each other: byte count, colon, text; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _depth(rows: Column, fanout: int) -> Column:
    """Levels above so many leaves: the least d with fanout ** d >= rows."""
    powers = [fanout**d for d in range(64) if fanout**d < 1 << 62]
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < rows))


def _placed(rows: DataFrame, order: Sequence[str], fanout: int, scratch: Scratch, label: str) -> DataFrame:
    """Add `pos`, the place within `key` in the given order, and `left`, the levels above the leaves of the key.

    Rows are dealt by ranges of (key, order, a number of the row), so neither a large key nor many equal rows meet in
    one task, and are written with their place in the range. Running totals go over one row per range and key.
    """
    ranged = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = ranged.repartitionByRange("key", *order, "_row").sortWithinPartitions("key", *order, "_row").drop("_row")
    stored = scratch.write(ranged.withColumn("_place", F.monotonically_increasing_id()), label)
    part = F.shiftright("_place", _LOCAL_BITS)
    sizes = stored.groupBy("key", part.alias("_part")).agg(F.count("*").alias("rows"), F.min("_place").alias("first"))
    earlier = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")
    total = F.sum("rows").over(Window.partitionBy("key"))
    offsets = sizes.select("key", "_part", before.alias("_offset"), _depth(total, fanout).alias("left"))
    numbered = stored.withColumn("_part", part).join(offsets, ["key", "_part"])
    return numbered.withColumn("pos", F.col("_offset") + F.col("_place")).drop("_place", "_part", "_offset")


def _pivot(nodes: DataFrame, fanout: int, levels: int, carried: Sequence[str] = ()) -> DataFrame:
    """Spread each `fanout ** levels` neighbours of a key into columns n0_0, n0_1, ..., and hash runs of columns into
    n1_0, ..., up to the columns of `levels`, or to the key's last level. `carried` are columns c0_0, ... as structs."""
    width = fanout**levels
    slot = F.pmod("pos", F.lit(width))

    def spread(name: str, value: Column) -> list[Column]:
        return [F.max(F.when(slot == s, value)).alias(f"{name}_{s}") for s in range(width)]

    columns = spread("n0", F.col("node")) + (spread("c0", F.struct(*carried)) if carried else [])
    block = F.expr(f"pos div {width}")
    wide = nodes.groupBy("key", block.alias("block")).agg(F.max("left").alias("left"), *columns)
    for level in range(1, levels + 1):
        parents = []
        for at in range(fanout ** (levels - level)):
            run = [F.col(f"n{level - 1}_{at * fanout + s}") for s in range(fanout)]
            joined = digest(*[F.coalesce(child, F.lit("")) for child in run])
            parents.append(F.when((F.col("left") >= level) & run[0].isNotNull(), joined).alias(f"n{level}_{at}"))
        wide = wide.select("*", *parents)
    return wide


def _climb(nodes: DataFrame, fanout: int, levels: int, scratch: Scratch, label: str, carried: Sequence[str] = ()) -> list[DataFrame]:
    """The pivoted tables from the leaves up to one row per key; each is `fanout ** levels` times smaller."""
    tables: list[DataFrame] = []
    while True:
        table = scratch.write(_pivot(nodes, fanout, levels, () if tables else carried), f"{label}-{len(tables)}")
        tables.append(table)
        if (table.agg(F.max("left")).first()[0] or 0) <= levels:
            return tables
        nodes = table.select("key", F.col("block").alias("pos"), _top(levels).alias("node"), F.greatest(F.col("left") - levels, F.lit(0)).alias("left"))


def _top(levels: int) -> Column:
    """The topmost node of a block."""
    return F.coalesce(*[F.col(f"n{level}_0") for level in range(levels, -1, -1)])


def _descend(tables: Sequence[DataFrame], above: DataFrame, fanout: int, levels: int, carried: bool = False) -> DataFrame:
    """(key, pos, node, path) of the leaves and what `above` has for each key; `path` has for each level up to the root
    the siblings before and after, as joined texts. A block takes its path by one row, and the leaves are spread after."""
    width = fanout**levels
    known = above.withColumn("pos", F.lit(0).cast("long"))
    more = [name for name in above.columns if name not in ("key", "path")]
    for number, table in reversed(list(enumerate(tables))):
        joined = table.join(known.withColumnRenamed("pos", "block"), ["key", "block"])
        own_levels = F.least(F.col("left"), F.lit(levels))
        children = []
        for s in range(width):
            steps = []
            for level in range(levels):
                at = s // fanout**level
                run = at // fanout * fanout
                sides = ([F.col(f"n{level}_{k}") for k in range(run, at)], [F.col(f"n{level}_{k}") for k in range(at + 1, run + fanout)])
                left, right = (F.concat(F.lit(""), *[F.coalesce(c, F.lit("")) for c in side]) for side in sides)
                steps.append(F.struct(left.alias("left"), right.alias("right")))
            path = F.concat(F.slice(F.array(*steps), F.lit(1), own_levels), F.col("path")).cast(_PATH)
            row = [(F.col("block") * width + s).alias("pos"), F.col(f"n0_{s}").alias("node"), path.alias("path")]
            if carried and number == 0:
                row.append(F.col(f"c0_{s}").alias("carried"))
            children.append(F.when(F.col(f"n0_{s}").isNotNull(), F.struct(*row)))
        each = joined.select("key", *more, F.explode(F.array(*children)).alias("child")).filter("child is not null")
        known = each.select("key", *more, "child.*")
        if number:
            known = known.drop("node")
    return known


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def manifest(rows: DataFrame, leaf: Column, group: Column, order: Column, carried: Sequence[Column] = (), fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """For each row: `leaf`, `subroot` of its group, `root`, `path` (siblings before and after, level by level up to the
    root), and the `carried` columns, whose types must have an order.

    Leaves of a group stand in the given order, null first, equal ones by their digest; every `fanout` consecutive nodes
    become one until one is left, a last run may be shorter. Subroots are treated likewise, by group, null first and then
    by UTF-8 bytes. Equal rows are leaves of their own and interchangeable. An empty table gives no rows.

    A text is read and hashed once and never shuffled. One grouping builds `levels` levels, so a table of N rows takes
    log(N) / log(fanout ** levels) of them over ever fewer rows. Siblings come down by one row per block; only the
    last join is of N / fanout ** levels rows. The driver gets the number of levels and one digest.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    names = [f"given_{at}" for at in range(len(carried))]
    hashed = rows.select(group_key(group).alias("key"), order.alias("order"), leaf.alias("node"), *[c.alias(n) for c, n in zip(carried, names, strict=True)])
    hashed = scratch.write(hashed, "merkle-leaves")
    placed = _placed(hashed, ["order", "node"], fanout, scratch, "merkle-placed")
    tables = _climb(placed, fanout, levels, scratch, "merkle-rows", names)
    scratch.drop("merkle-leaves", "merkle-placed")
    subroots = tables[-1].select(F.col("key").alias("group"), _top(levels).alias("node"))
    top = _placed(subroots.select(F.lit("").alias("key"), "group", "node"), ["group"], fanout, scratch, "merkle-groups")
    tops = _climb(top, fanout, levels, scratch, "merkle-top", ["group"])
    root = tops[-1].select(_top(levels)).first()  # one digest
    above = spark.createDataFrame([("",)], "key string").withColumn("path", F.array().cast(_PATH))
    groups = _descend(tops, above, fanout, levels, carried=True)
    groups = groups.select(F.col("carried.group").alias("key"), F.col("node").alias("subroot"), "path")
    leaves = _descend(tables, groups, fanout, levels, carried=bool(names))
    own = [F.col(f"carried.{name}").alias(name) for name in names]
    return leaves.select(F.col("node").alias("leaf"), "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "path", *own)


def document_manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Proofs of all documents, and what they give for rows that were tampered with.

    A row is tampered with where `TAMPERED_OF` divides the crc32 of its doc_id as text: n_chars is one more. Null
    doc_ids and null n_chars stay as they are. Only the columns of `LEAF_COLUMNS` count, so others may have any name.
    """
    docs = docs.select(*LEAF_COLUMNS)
    values = [F.col(name) for name in LEAF_COLUMNS]
    more = [F.col("n_chars").cast("decimal(20,0)") + 1 if name == "n_chars" else F.col(name) for name in LEAF_COLUMNS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED_OF == 0
    changed = F.when(tampered & F.col("n_chars").isNotNull(), digest(*map(field, more)))
    rows = manifest(docs, digest(*map(field, values)), F.col("lang"), F.col("doc_id").cast("long"), [F.col("doc_id").cast("long"), changed], fanout, levels)
    proved = rows.select(
        F.col("given_0").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("given_1", "leaf"), F.col("path")).alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_manifest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(({value})::VARCHAR)::VARCHAR || ':' || ({value})::VARCHAR END"


def _sql_tree(name: str, source: str) -> str:
    return f"""{name} AS (
    SELECT key, 0 AS level, pos, node, n FROM {source}
    UNION ALL
    SELECT key, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2
    FROM {name} WHERE n > 1 GROUP BY key, level, pos // 2, n)"""


def _sql_path(name: str, source: str, tree: str) -> str:
    """One row per leaf and level below the last: the side and digest of its sibling, or an empty text."""
    return f"""{name} AS (
    SELECT s.id, l.level, CASE WHEN t.node IS NULL THEN '' WHEN (s.pos >> l.level) % 2 = 1 THEN 'L' || t.node ELSE 'R' || t.node END AS step
    FROM {source} s JOIN (SELECT DISTINCT key, level FROM {tree} WHERE n > 1) l ON l.key = s.key
    LEFT JOIN {tree} t ON t.key = s.key AND t.level = l.level AND t.pos = xor(s.pos >> l.level, 1))"""


ORACLE_SQL = f"""
WITH RECURSIVE
hashed AS (
    SELECT doc_id, n_chars, coalesce('=' || lang, '') AS key,
        sha256({" || ".join(_sql_field(c) for c in LEAF_COLUMNS)}) AS leaf,
        sha256({" || ".join(_sql_field("n_chars + 1" if c == "n_chars" else c) for c in LEAF_COLUMNS)}) AS other,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda r, i: xor(r >> 1, 3988292384 * (r & 1))))) % 7 = 0 AS tampered
    FROM documents),
leaves AS (
    SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY key) AS n, leaf AS node
    FROM hashed),
{_sql_tree("tree", "leaves")},
subroots AS (
    SELECT key AS name, node, row_number() OVER (ORDER BY key) AS id, row_number() OVER (ORDER BY key) - 1 AS pos,
        count(*) OVER () AS n, 0 AS key
    FROM tree WHERE n = 1),
{_sql_tree("top", "subroots")},
{_sql_path("low_steps", "leaves", "tree")},
{_sql_path("high_steps", "subroots", "top")},
low AS (SELECT id, list(step ORDER BY level) AS steps FROM low_steps GROUP BY id),
high AS (SELECT id, list(step ORDER BY level) AS steps FROM high_steps GROUP BY id),
paths AS (
    SELECT l.*, s.node AS subroot, list_concat(coalesce(low.steps, []::VARCHAR[]), coalesce(high.steps, []::VARCHAR[])) AS steps
    FROM leaves l JOIN subroots s ON s.name = l.key LEFT JOIN low ON low.id = l.id LEFT JOIN high ON high.id = s.id),
folded AS (
    SELECT *, list_reduce(list_prepend(CASE WHEN tampered AND n_chars IS NOT NULL THEN other ELSE leaf END, steps),
        lambda node, step: sha256(CASE WHEN step[1] = 'L' THEN step[2:] || node ELSE node || step[2:] END)) AS folded_root
    FROM (SELECT p.*, r.node AS root FROM paths p, (SELECT node FROM top WHERE n = 1) r))
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda step: step[2:]), '')) AS proof_sha256,
    folded_root, folded_root = root AS verified
FROM folded
"""
