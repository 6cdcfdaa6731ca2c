"""Landing files to Bronze, Silver and Gold, one micro-batch at a time, safe to replay.

A failed batch is logged and raised again: the checkpoint stays where it was, nothing of the
batch is visible, and the next start runs it again with the time stamp of its first attempt.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from vendorium.operators import history, latest, routing
from vendorium.operators.numbering import number_rows
from vendorium.plans import audit, gold
from vendorium.schemas import (
    DIM_SUPPLIERS,
    DQ_SUMMARY as DQ_SUMMARY_SCHEMA,
    PIPE_LOAD_LOG,
    PIPELINE_RUN_LOG,
    REJECTED_SUPPLIERS,
    conform,
)
from vendorium.session import discarding_scratch, materialize, same_splits
from vendorium.sources import csv_batches
from vendorium.sources.csv_records import FILE
from vendorium.sources.ledger import Ledger
from vendorium.sources.tables import (
    AGG_RISK_SPEND,
    CHANGES,
    DQ_SUMMARY,
    GOLD_STATE,
    KPI_SNAPSHOT,
    LOAD_LOG,
    RAW,
    REJECTED,
    SupplierTables,
)
from vendorium.streaming.triggers import TriggerCounts

# Names under which runs and loads are logged.
PIPE = "PIPE_RAW_SUPPLIERS"
SILVER = ("TASK_BRONZE_TO_SILVER", "SP_BRONZE_TO_SILVER")
GOLD = ("TASK_SILVER_TO_GOLD", "SP_SILVER_TO_GOLD")

# Order in which files arrived, and rows in them. The hash only decides between rows that share a file position.
ARRIVAL = ("file_time", "source_file_name", "source_row_number", "record_hash")
_NO_COUNTS = ("processed", "inserted", "updated", "rejected")
_FIRST = {"base": None, "since": [], "dead": [], "merged_runs": 0, "offset": 0, "last_ids": dict.fromkeys(("log", "summary", "reject", "sk"), 0)}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _stamp(moment: datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


class SupplierPipeline:
    def __init__(self, tables: SupplierTables, clock: Callable[[], datetime] = utc_now) -> None:
        self.tables, self.clock = tables, clock
        self.triggers = TriggerCounts()
        self._ledger: Ledger | None = None
        self._resume = False

    # Streaming

    def start(self, landing: str, every: str | None = None, resume: bool = False, **limits: str) -> StreamingQuery:
        """Process new files: all that are there and stop, or `every` interval until stopped.

        The checkpoint lives with the tables, because its batch numbers are theirs. Without
        new files there is no batch, so nothing is written and nothing is logged. Files whose names
        the source passes over are offered under other names, before the start and with every batch.

        Tables written under another checkpoint are refused. After the loss of a checkpoint `resume`
        accepts a new one: its batches are numbered after the last one published, and files that the
        load log names are not loaded again.
        """
        spark = self.tables.spark
        self._ledger = Ledger(spark, landing, f"{self.tables.root}/offered")
        self._resume = resume
        self._offer()
        if every:
            self.triggers.listen(spark)
        lines = csv_batches.stream_lines(spark, self._ledger.source(landing), **limits)
        trigger = {"processingTime": every} if every else {"availableNow": True}
        return (
            lines.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.tables.root}/_checkpoint")
            .trigger(**trigger)
            .start()
        )

    def _offer(self) -> None:
        if self._ledger is not None and self._ledger.offers:
            self._ledger.offer(self.tables.load_log())

    def process(self, lines: DataFrame, batch_id: int) -> str:
        """One batch from lines to Gold. A batch that is already published only refreshes Gold."""
        with discarding_scratch(self.tables.spark):
            result = self._process(lines, batch_id)
            self._offer()
            return result

    def _numbered_batch(self, last: dict | None, batch_id: int) -> tuple[int, int]:
        """The batch's number in the tables, and by how much it is higher than the stream's own."""
        if last is None:
            return batch_id, 0
        known, running = last.get("query_id"), self._query_id()
        if known and running and known != running:
            # A new checkpoint counts batches from 0 again; they would be taken for published ones and lost.
            if not self._resume:
                raise RuntimeError(f"the tables were written by streaming query {known}, this is {running}: restore its checkpoint, resume with a new one, or use new tables")
            return last["batch_id"] + 1 + batch_id, last["batch_id"] + 1
        return last["offset"] + batch_id, last["offset"]

    def _process(self, lines: DataFrame, stream_batch: int) -> str:
        last = self.tables.last_commit()
        try:
            batch_id, offset = self._numbered_batch(last, stream_batch)
        except RuntimeError as refusal:
            self._log(SILVER, last["batch_id"] + 1, self.clock(), dict.fromkeys(_NO_COUNTS, 0), refusal)
            raise
        if last is not None and last["batch_id"] >= batch_id:
            commit = last
            self._log_again(SILVER, commit)
        else:
            commit = self._logged(SILVER, batch_id, lambda: self._bronze_to_silver(lines, batch_id, offset))
        if commit["counts"] is None:
            return "NO_DATA: the batch holds no rows."
        if self.tables.last_gold() != commit["batch_id"]:
            self._logged(GOLD, commit["batch_id"], lambda: self._silver_to_gold(commit))
        return "SUCCESS: " + ", ".join(f"{name}={n}" for name, n in commit["counts"].items())

    def _query_id(self) -> str | None:
        """The id that the checkpoint holds; none outside a stream."""
        return self.tables.spark.sparkContext.getLocalProperty("sql.streaming.queryId")

    # Run log

    def _logged(self, job: tuple[str, str], batch_id: int, work: Callable[[], dict]) -> dict:
        started = self.clock()
        try:
            result = work()
        except Exception as error:
            self._log(job, batch_id, started, dict.fromkeys(_NO_COUNTS, 0), error)
            raise
        if result["counts"] is not None:
            self._log(job, batch_id, started, result["counts"], None)
        return result

    @staticmethod
    def _run_name(job: tuple[str, str], batch_id: int) -> str:
        return f"{batch_id:012d}-{job[1]}"

    def _log_again(self, job: tuple[str, str], commit: dict) -> None:
        """Write the row of a batch that was published but stopped before it was logged."""
        missing = commit["batch_id"] in commit["since"] and not self.tables.run_written(self._run_name(job, commit["batch_id"]))
        if commit["counts"] is not None and missing:
            self._log(job, commit["batch_id"], datetime.fromisoformat(commit["run_ts"]), commit["counts"], None)

    def _log(self, job: tuple[str, str], batch_id: int, started: datetime, counts: dict, error: Exception | None) -> None:
        """Write one row, in a folder of its own."""
        run_id = self.tables.next_run_id()
        name = self._run_name(job, batch_id) + (f"-failed-{run_id}" if error else "")
        row = {
            "run_id": run_id,
            "task_name": job[0],
            "procedure_name": job[1],
            "start_time": started.isoformat(sep=" "),
            "end_time": self.clock().isoformat(sep=" "),
            **{f"rows_{name}": counts[name] for name in _NO_COUNTS},
            "status": "FAILED" if error else "SUCCESS",
            "error_message": str(error) if error else None,
        }
        one = self.tables.spark.range(0, 1, 1, 1).select(*[F.lit(value).alias(column) for column, value in row.items()])
        self.tables.write_run(name, conform(one, PIPELINE_RUN_LOG))

    # Bronze to Silver

    def _ingest(self, lines: DataFrame, batch_id: int, run_ts: Column, last_log_id: int, skip_loaded: bool = False) -> int:
        """Write the batch's raw rows and load log; the number of files logged."""
        tables = self.tables
        first_name = self._ledger.first_name if self._ledger is not None else lambda name: name
        rows = csv_batches.split_rows(lines, first_name)
        if skip_loaded:  # a new checkpoint offers every file again; a join may put rows elsewhere when it is done again
            rows = rows.join(tables.load_log().select(F.col("file_name").alias(FILE)), FILE, "left_anti").persist()
        try:
            with same_splits(tables.spark), same_splits(lines.sparkSession), discarding_scratch(tables.spark):
                tables.write_batch(csv_batches.parse(rows, run_ts), RAW, batch_id, "_loaded")
        finally:
            if skip_loaded:
                rows.unpersist()
        stored = tables.raw_batch(batch_id, True).unionByName(tables.raw_batch(batch_id, False))
        log = number_rows(audit.load_log(stored, PIPE, run_ts), "log_id", ("file_name",), last_log_id)
        tables.write_batch(conform(log, PIPE_LOAD_LOG), LOAD_LOG, batch_id)
        return tables.load_log_of(batch_id).count()

    def _bronze_to_silver(self, lines: DataFrame, batch_id: int, offset: int = 0) -> dict:
        tables = self.tables
        last = tables.last_commit() or _FIRST
        ids = dict(last["last_ids"])
        moment = tables.batch_start(batch_id, self.clock())
        run_ts = _stamp(moment)

        ids["log"] += self._ingest(lines, batch_id, run_ts, ids["log"], offset > 0)
        raw = tables.raw_batch(batch_id)
        summary = routing.quality_summary(raw, run_ts.cast("date"))
        summary = conform(summary.withColumn("summary_id", F.lit(ids["summary"] + 1)), DQ_SUMMARY_SCHEMA)
        tables.write_batch(summary, DQ_SUMMARY, batch_id)
        written = tables.summary_of(batch_id).first()
        total, rejected = written.total_records, written.failed_records
        ids["summary"] += 1

        flagged = routing.flag(raw)
        rejects = number_rows(routing.rejects(flagged, run_ts), "reject_id", after=ids["reject"])
        tables.write_batch(conform(rejects, REJECTED_SUPPLIERS), REJECTED, batch_id)
        ids["reject"] += rejected

        # One row per supplier and file: the last one in the file, whose rows have numbers of their own. It is found
        # before text is standardised and hashed, which most rows then need not be.
        last_rows = latest.latest_per_key(flagged.filter("_dq_passed"), ("supplier_id", FILE), ("_source_row_number",))
        accepted = routing.accepted(last_rows, "_file_time").withColumnRenamed("_file_time", "file_time")
        staged = materialize(accepted, "staged")
        opened, closed = self._update_dimension(staged, batch_id, run_ts, ids["sk"])
        ids["sk"] += opened

        counts = None
        if total:
            counts = {
                "processed": opened + rejected,
                "inserted": opened,
                "updated": closed,
                "rejected": rejected,
                "superseded": total - rejected - staged.count(),
            }
        commit = _FIRST | last | {
            "batch_id": batch_id,
            "run_ts": moment.isoformat(),
            "since": [*last["since"], batch_id],
            "last_ids": ids,
            "counts": counts,
            "query_id": self._query_id() or last.get("query_id"),
            "offset": offset,
        }
        tables.publish(commit)
        return commit

    def _update_dimension(self, staged: DataFrame, batch_id: int, run_ts: Column, last_sk: int) -> tuple[int, int]:
        """Open a version for every delivery that changes its supplier, and close the one before.

        What the batch adds is all that is written: opened versions, and closed ones as whole rows. Stored versions are
        read from the files that can hold the batch's suppliers; every join has the batch as its small side and Parquet
        sizes to judge it by, so a small batch is broadcast and the stored versions are not shuffled for it.
        """
        tables = self.tables
        current = tables.current(staged.select("supplier_id"))
        known = current.select("supplier_id", "record_hash").join(staged.select("supplier_id"), "supplier_id", "left_semi")
        new = history.open_versions(staged, known, run_ts, ARRIVAL)
        opened = number_rows(new, "supplier_sk", ("supplier_id", "valid_from"), last_sk).select(*DIM_SUPPLIERS.names)
        replaced = history.expire(current.join(opened.select("supplier_id"), "supplier_id", "left_semi"), run_ts)
        rows = opened.withColumn("_was_open", F.lit(False)).unionByName(replaced.select(*DIM_SUPPLIERS.names).withColumn("_was_open", F.lit(True)))
        tables.write_batch(rows, CHANGES, batch_id, "is_current")
        written = tables.changes([batch_id]).agg(
            F.count_if(~F.col("_was_open")).alias("opened"), F.count_if(~F.col("is_current")).alias("closed")
        )
        return tuple(written.first())

    # Silver to Gold

    def _silver_to_gold(self, commit: dict) -> dict:
        """Gold from the last one and what the batches since have opened and closed; only without a last one, or if its
        changes were folded away, from all open versions."""
        tables, version = self.tables, commit["batch_id"]
        run_ts = _stamp(datetime.fromisoformat(commit["run_ts"]))
        last = tables.last_gold()
        missed = None if last is None else range(last + 1, version + 1)
        if missed is None or not set(missed) <= set(commit["since"]):
            state = gold.state_of(tables.current())
        else:
            state = gold.merged_state(tables.gold_state(), gold.state_change(tables.changes(list(missed))))
        tables.write_gold(state, GOLD_STATE, version)
        state = tables.gold_version(GOLD_STATE, version)
        tables.write_gold(gold.agg_risk_spend_of(state, run_ts), AGG_RISK_SPEND, version)
        tables.write_gold(gold.kpi_snapshot_of(state, run_ts.cast("date"), run_ts), KPI_SNAPSHOT, version)
        tables.publish_gold(version)
        rows = tables.agg_risk_spend().count() + tables.kpi_snapshot().count()
        return {"counts": {"processed": rows, "inserted": rows, "updated": 0, "rejected": 0}}
