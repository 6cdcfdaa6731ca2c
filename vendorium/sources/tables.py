"""The medallion tables as Parquet folders, made visible batch by batch.

Every batch writes folders of its own and is published by one small commit file that names
what is live. Readers start at the newest commit, so a batch that stopped half way is never
seen and is simply written again.

A batch only adds: the versions it opens, and the versions it closes, each as a whole row. The
open versions are those opened and not closed, by key. `fold`, a plain job to be run now and
then, writes them out as files of supplier-id ranges with each file's least and greatest id, so
that a batch reads only files that can hold its suppliers.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from vendorium import schemas
from vendorium.operators.history import clean_state
from vendorium.session import materialize

RAW, REJECTED = "bronze/raw_suppliers", "silver/rejected_suppliers"
CHANGES, BASE, BASE_FILES, SETTLED = (f"silver/dim_suppliers/{part}" for part in ("changes", "base", "base_files", "settled"))
LOAD_LOG, DQ_SUMMARY, RUN_LOG = "audit/pipe_load_log", "audit/dq_summary", "audit/pipeline_run_log"
AGG_RISK_SPEND, KPI_SNAPSHOT, GOLD_STATE = "gold/agg_risk_spend", "gold/kpi_snapshot", "gold/state"
GOLD_SCHEMAS = {AGG_RISK_SPEND: schemas.AGG_RISK_SPEND, KPI_SNAPSHOT: schemas.KPI_SNAPSHOT, GOLD_STATE: schemas.GOLD_STATE}
MERGED = "_merged"  # log tables of folded batches lie next to the table under its name with this

MOST_IDS = 10_000  # up to so many suppliers a batch's files are picked by each id, beyond by least and greatest
_BATCH = T.StructField("ingest_batch", T.LongType())
_INTERNAL = [T.StructField("_error", T.StringType()), T.StructField("_file_time", T.TimestampType())]
_WAS_OPEN = T.StructField("_was_open", T.BooleanType())


class Folder:
    """The few file operations that commits need, on whatever file system holds the tables."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark._jvm
        self._base = self._jvm.org.apache.hadoop.fs.Path(root)
        self._fs = self._base.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._base, name)

    def names(self, name: str) -> list[str]:
        path = self._path(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Write aside and rename, so that the file is seen whole or not at all."""
        aside = f"{name}.tmp"
        self.replace(aside, text)
        if not self._fs.rename(self._path(aside), self._path(name)):
            raise OSError(f"could not publish {name}")

    def replace(self, name: str, text: str) -> None:
        """Write in place; a reader may see it half written."""
        stream = self._fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class Sequence:
    """Small numbered files of which the newest counts.

    A pointer says where to look, and files after it are tried one by one. So finding the newest costs the same after
    a hundred thousand batches, and a pointer that is old, half written or lost does no harm.
    """

    def __init__(self, folder: Folder, kind: str) -> None:
        self._folder, self._kind = folder, kind
        self._pointer = f"_commits/newest-{kind}.txt"

    def _name(self, number: int) -> str:
        return f"_commits/{self._kind}-{number:012d}.json"

    def _listed(self) -> list[int]:
        names = self._folder.names("_commits")
        return [int(n[len(self._kind) + 1 : -5]) for n in names if n.startswith(f"{self._kind}-") and n.endswith(".json")]

    def number(self) -> int:
        """The newest number, 0 for none."""
        try:
            number = int(self._folder.read(self._pointer))
        except Exception:  # no pointer, or not a whole one
            number = max(self._listed(), default=0)
        while self._folder.exists(self._name(number + 1)):
            number += 1
        return number

    def newest(self) -> dict | None:
        number = self.number()
        return json.loads(self._folder.read(self._name(number))) if number else None

    def publish(self, content: dict) -> None:
        number = self.number() + 1
        self._folder.write(self._name(number), json.dumps(content))
        self._folder.replace(self._pointer, str(number))

    def drop_older(self) -> int:
        older = [number for number in self._listed() if number < self.number()]
        for number in older:
            self._folder.delete(self._name(number))
        return len(older)


class SupplierTables:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.folder = Folder(spark, self.root)
        self._commits, self._golds = Sequence(self.folder, "batch"), Sequence(self.folder, "gold")

    # Commits

    def last_commit(self) -> dict | None:
        return self._commits.newest()

    def publish(self, commit: dict) -> None:
        self._commits.publish(commit)
        self.folder.delete(self._start(commit["batch_id"]))  # the commit has the time now

    def last_gold(self) -> int | None:
        newest = self._golds.newest()
        return newest and newest["version"]

    def publish_gold(self, version: int) -> None:
        if self.last_gold() != version:
            self._golds.publish({"version": version})

    def _start(self, batch_id: int) -> str:
        return f"_commits/start-{batch_id:012d}.txt"

    def batch_start(self, batch_id: int, now: datetime) -> datetime:
        """The batch's one time stamp, kept from its first attempt."""
        name = self._start(batch_id)
        if not self.folder.exists(name):
            self.folder.write(name, now.isoformat())
        return datetime.fromisoformat(self.folder.read(name))

    def next_run_id(self) -> int:
        """The next number of the run log. It is taken before its row is written, so a crash leaves a gap at most."""
        name = "_commits/run.txt"
        try:
            number = int(self.folder.read(name))
        except Exception:  # the first run, or a pointer that was lost
            number = self.run_log().agg(F.max("run_id")).first()[0] or 0
        self.folder.replace(name, str(number + 1))
        return number + 1

    # Writing

    def batch_path(self, table: str, batch_id: int) -> str:
        return f"{self.root}/{table}/ingest_batch={batch_id}"

    def write_batch(self, df: DataFrame, table: str, batch_id: int, *partitions: str) -> None:
        df.write.mode("overwrite").partitionBy(*partitions).parquet(self.batch_path(table, batch_id))

    def write_gold(self, df: DataFrame, table: str, version: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/version={version}")

    def run_written(self, name: str) -> bool:
        return self.folder.exists(f"{RUN_LOG}/{name}/_SUCCESS")

    def write_run(self, name: str, run: DataFrame) -> None:
        run.write.mode("overwrite").parquet(f"{self.root}/{RUN_LOG}/{name}")

    # Reading

    def _empty(self, schema: T.StructType) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def _read(self, table: str, schema: T.StructType, *more: T.StructField, paths: list[str] | None = None) -> DataFrame:
        base = f"{self.root}/{table}"
        known = set(schema.names)
        full = T.StructType(schema.fields + [f for f in (_BATCH, *more) if f.name not in known])
        return self.spark.read.schema(full).option("basePath", base).parquet(*(paths or [base]))

    def _published(self, table: str, schema: T.StructType, *more: T.StructField) -> DataFrame:
        commit = self.last_commit()
        if commit is None:
            return self._empty(T.StructType(schema.fields + list(more)))
        return self._read(table, schema, *more).filter(F.col("ingest_batch") <= commit["batch_id"])

    def raw(self) -> DataFrame:
        rows = self._published(RAW, schemas.RAW_SUPPLIERS, T.StructField("_loaded", T.BooleanType()))
        return rows.filter("_loaded").select(*schemas.RAW_SUPPLIERS.names)

    def raw_batch(self, batch_id: int, loaded: bool = True) -> DataFrame:
        """One batch, published or not: its loaded rows, or headers and failed rows with their `_error`; each row with
        the time of its file."""
        schema = T.StructType(schemas.RAW_SUPPLIERS.fields + _INTERNAL)
        rows = self._read(RAW, schema, T.StructField("_loaded", T.BooleanType()), paths=[self.batch_path(RAW, batch_id)])
        return rows.filter(F.col("_loaded") == loaded).drop("_loaded", "ingest_batch")

    def load_errors(self) -> DataFrame:
        schema = T.StructType(schemas.RAW_SUPPLIERS.fields + _INTERNAL)
        rows = self._published(RAW, schema, T.StructField("_loaded", T.BooleanType()))
        failed = rows.filter(~F.col("_loaded") & F.col("_error").isNotNull())
        return failed.select("_source_file_name", "_source_row_number", F.col("_error").alias("error"), "_load_ts")

    def rejected(self) -> DataFrame:
        return self._published(REJECTED, schemas.REJECTED_SUPPLIERS).select(*schemas.REJECTED_SUPPLIERS.names)

    def changes(self, batches: list[int]) -> DataFrame:
        """What these batches opened and closed, published or not; `_was_open` tells closed rows that an earlier batch
        had opened from those that were opened and closed in one batch."""
        schema = T.StructType([f for f in schemas.DIM_SUPPLIERS.fields if f.name != "is_current"] + [_WAS_OPEN])
        if not batches:
            return self._empty(T.StructType(schemas.DIM_SUPPLIERS.fields + [_WAS_OPEN, _BATCH]))
        paths = [self.batch_path(CHANGES, batch) for batch in batches]
        rows = self._read(CHANGES, schema, T.StructField("is_current", T.BooleanType()), paths=paths)
        return rows.select(*schemas.DIM_SUPPLIERS.names, "_was_open", "ingest_batch")

    def base_paths(self, fold: int, ids: DataFrame | None = None) -> list[str]:
        """Files of the folded open versions, all or those that can hold a supplier of `ids`.

        Files hold ranges of ids, so one binary search tells an id's file. The driver gets one row per file between the
        least and the greatest id, and the ids themselves only if they are at most `MOST_IDS`.
        """
        files = self.spark.read.parquet(f"{self.root}/{BASE_FILES}/fold={fold}")
        if ids is None:
            return sorted(row.file for row in files.select("file").collect())
        least, greatest = ids.agg(F.min("supplier_id"), F.max("supplier_id")).first()
        if least is None:
            return []
        near = files.filter((F.col("greatest") >= least) & (F.col("least") <= greatest)).orderBy("least", "greatest").collect()
        some = ids.select("supplier_id").distinct().limit(MOST_IDS + 1).collect()
        if len(some) > MOST_IDS:
            return [row.file for row in near]
        ends = [row.greatest for row in near]
        hit = {at for row in some if (at := bisect_left(ends, row.supplier_id)) < len(near) and near[at].least <= row.supplier_id}
        return [near[at].file for at in sorted(hit)]

    def current(self, ids: DataFrame | None = None) -> DataFrame:
        """Open versions: all, or, given `ids`, at least those of its suppliers, from files that can hold them."""
        commit = self.last_commit()
        if commit is None:
            return self._empty(schemas.DIM_SUPPLIERS)
        since = self.changes(commit["since"])
        opened = since.filter("is_current").select(*schemas.DIM_SUPPLIERS.names)
        if commit["base"] and (files := self.base_paths(commit["base"], ids)):
            base = f"{self.root}/{BASE}/fold={commit['base']}"
            opened = opened.unionByName(self.spark.read.schema(schemas.DIM_SUPPLIERS).parquet(*[f"{base}/{file}" for file in files]))
        closed = since.filter("NOT is_current AND _was_open").select("supplier_sk")
        return opened.join(closed, "supplier_sk", "left_anti").select(*schemas.DIM_SUPPLIERS.names)

    def closed(self) -> DataFrame:
        commit = self.last_commit()
        if commit is None:
            return self._empty(schemas.DIM_SUPPLIERS)
        rows = self.changes(commit["since"]).filter("NOT is_current").select(*schemas.DIM_SUPPLIERS.names)
        if commit["base"]:
            settled = self.spark.read.schema(T.StructType(schemas.DIM_SUPPLIERS.fields + [T.StructField("fold", T.LongType())]))
            folds = settled.parquet(f"{self.root}/{SETTLED}").filter(F.col("fold") <= commit["base"])
            rows = rows.unionByName(folds.select(*schemas.DIM_SUPPLIERS.names))
        return rows

    def closed_in(self, batch_id: int) -> DataFrame:
        """Versions that one batch closed, published or not."""
        return self.changes([batch_id]).filter("NOT is_current").select(*schemas.DIM_SUPPLIERS.names)

    def dimension(self) -> DataFrame:
        return self.closed().unionByName(self.current())

    def clean(self) -> DataFrame:
        """The current-state table. Its rows are the open versions, so they are stored once."""
        return clean_state(self.current())

    def _log(self, table: str, schema: T.StructType) -> DataFrame:
        """A log table: what the last fold put together, and the batches since."""
        commit = self.last_commit()
        if commit is None:
            return self._empty(schema)
        parts = [self._read(table, schema, paths=[self.batch_path(table, batch) for batch in commit["since"]])] if commit["since"] else []
        if commit["base"]:
            parts.append(self.spark.read.schema(schema).parquet(f"{self.root}/{table}{MERGED}/fold={commit['base']}"))
        rows = parts[0].select(*schema.names)
        return rows.unionByName(parts[1].select(*schema.names)) if len(parts) > 1 else rows

    def load_log(self) -> DataFrame:
        return self._log(LOAD_LOG, schemas.PIPE_LOAD_LOG)

    def load_log_of(self, batch_id: int) -> DataFrame:
        return self._read(LOAD_LOG, schemas.PIPE_LOAD_LOG, paths=[self.batch_path(LOAD_LOG, batch_id)]).select(*schemas.PIPE_LOAD_LOG.names)

    def dq_summary(self) -> DataFrame:
        return self._log(DQ_SUMMARY, schemas.DQ_SUMMARY)

    def summary_of(self, batch_id: int) -> DataFrame:
        """The quality summary of one batch, published or not."""
        return self._read(DQ_SUMMARY, schemas.DQ_SUMMARY, paths=[self.batch_path(DQ_SUMMARY, batch_id)])

    def run_log(self) -> DataFrame:
        """All runs, also failed ones, which no commit names: those put together, and those with a higher number."""
        commit = self.last_commit()
        rows = self._empty(schemas.PIPELINE_RUN_LOG)
        if self.folder.exists(RUN_LOG):
            reader = self.spark.read.schema(schemas.PIPELINE_RUN_LOG).option("recursiveFileLookup", "true")
            rows = reader.parquet(f"{self.root}/{RUN_LOG}")
        if commit is None or not commit["base"]:
            return rows
        merged = self.spark.read.schema(schemas.PIPELINE_RUN_LOG).parquet(f"{self.root}/{RUN_LOG}{MERGED}/fold={commit['base']}")
        return merged.unionByName(rows.filter(F.col("run_id") > commit["merged_runs"]))

    def gold_version(self, table: str, version: int | None) -> DataFrame:
        """One version of a Gold table, published or not; empty without one."""
        schema = GOLD_SCHEMAS[table]
        if version is None:
            return self._empty(schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/version={version}")

    def agg_risk_spend(self) -> DataFrame:
        return self.gold_version(AGG_RISK_SPEND, self.last_gold())

    def kpi_snapshot(self) -> DataFrame:
        return self.gold_version(KPI_SNAPSHOT, self.last_gold())

    def gold_state(self) -> DataFrame:
        """Counts and sums from which the last published Gold was made."""
        return self.gold_version(GOLD_STATE, self.last_gold())

    # Upkeep

    def fold(self) -> bool:
        """Write the open versions anew by ranges of supplier id, and put small log files together.

        A plain job between batches, not beside one. It is published like a batch, and reading gives the same before
        and after. What it replaces goes with the next `vacuum`. Nothing happens without batches since the last one.
        """
        commit = self.last_commit()
        if commit is None or not commit["since"]:
            return False
        fold = (commit["base"] or 0) + 1
        ranged = self.current().repartitionByRange("supplier_id").sortWithinPartitions("supplier_id")
        base = f"{self.root}/{BASE}/fold={fold}"
        ranged.write.mode("overwrite").parquet(base)
        written = self.spark.read.schema(schemas.DIM_SUPPLIERS).parquet(base)
        files = written.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("supplier_id").alias("least"), F.max("supplier_id").alias("greatest"), F.count("*").alias("versions")
        )
        files.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{BASE_FILES}/fold={fold}")  # one row per file
        closed = self.changes(commit["since"]).filter("NOT is_current").select(*schemas.DIM_SUPPLIERS.names)
        closed.write.mode("overwrite").parquet(f"{self.root}/{SETTLED}/fold={fold}")
        runs = materialize(self.run_log(), "runs")
        for table, rows in ((LOAD_LOG, self.load_log()), (DQ_SUMMARY, self.dq_summary()), (RUN_LOG, runs)):
            rows.write.mode("overwrite").parquet(f"{self.root}/{table}{MERGED}/fold={fold}")
        dead = [f"{table}/ingest_batch={batch}" for batch in commit["since"] for table in (CHANGES, LOAD_LOG, DQ_SUMMARY)]
        if commit["base"]:
            dead += [f"{table}/fold={commit['base']}" for table in (BASE, BASE_FILES, *(f"{log}{MERGED}" for log in (LOAD_LOG, DQ_SUMMARY, RUN_LOG)))]
        dead += [f"{RUN_LOG}/{name}" for name in self.folder.names(RUN_LOG)]
        merged = runs.agg(F.max("run_id")).first()[0] or 0
        self._commits.publish(commit | {"base": fold, "since": [], "merged_runs": merged, "dead": commit["dead"] + dead})
        return True

    def vacuum(self) -> int:
        """Delete what folds have replaced, Gold versions and commits before the newest; for use while nobody reads."""
        commit = self.last_commit()
        if commit is None:
            return 0
        for folder in commit["dead"]:
            self.folder.delete(folder)
        removed = len(commit["dead"])
        if removed:
            self._commits.publish(commit | {"dead": []})
        newest = self.last_gold()
        for table in (AGG_RISK_SPEND, KPI_SNAPSHOT, GOLD_STATE):
            for name in self.folder.names(table):
                if newest is not None and name.startswith("version=") and int(name.removeprefix("version=")) < newest:
                    self.folder.delete(f"{table}/{name}")
                    removed += 1
        return removed + self._commits.drop_older() + self._golds.drop_older()
