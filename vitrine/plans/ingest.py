"""Ingest job: changed hourly logs -> cleaned, sequenced rows -> keyed upsert.

One run = one micro-batch:
  list files (sizes only) -> pick the current/previous hour (or a back-fill range)
  -> compare with the size watermark, keep changed files
  -> header-mapped read -> clean / type -> quarantine rows without event time
  -> event_seq per file (skew-safe, split-aware) -> staging copy of all rows, the last
     write of every key marked -> what each file changes (inserted, updated, unchanged)
  -> merge of the last writes into touched day/hour partitions
  -> run log (never blocks) -> watermark (only after the table is written)
  -> journal 'committed'.
A run that dies anywhere before the watermark append is simply repeated by the next
run (the merge is idempotent); a run that dies inside the partition overwrite is
finished from its staging copy by ``recover()``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.merge import change_set, changes_per_file
from vitrine.operators.sequence import mark_last_write
from vitrine.operators.watermark import current_watermark, file_changes, watermark_entries
from vitrine.plans import transform as tf
from vitrine.plans.tables import LakeTable, MergeJournal, append_log, delete_path, path_exists
from vitrine.session import shared_dir
from vitrine.sources.listing import list_hourly_logs, select_ingest_files
from vitrine.sources.logscan import path_key, read_log
from vitrine.spec import (CUT2_MERGE_KEYS, EXTRACTION_COLUMN, REQUIRED_FILE_COLUMNS, RUN_MESSAGE_LIMIT,
                          TRANSITION_WINDOW_MINUTES)

__all__ = ["IngestConfig", "IngestJob"]


@dataclass
class IngestConfig:
    source_root: str
    table_path: str
    state_path: str
    sep: str = ";"
    partition_cols: tuple[str, ...] = ("event_date", "event_hour")
    merge_mode: str = "update"            # 'update' (DO UPDATE) or 'ignore' (DO NOTHING)
    zero_id_rule: bool = False
    on_corrupt: str = "fail_file"
    window_minutes: int = TRANSITION_WINDOW_MINUTES
    compare_mtime: bool = False           # also re-read equal-size files that were rewritten
    keys: tuple[str, ...] = field(default=CUT2_MERGE_KEYS)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class IngestJob:
    def __init__(self, spark: SparkSession, cfg: IngestConfig):
        self.spark, self.cfg = spark, cfg
        self.table = LakeTable(spark, cfg.table_path, cfg.partition_cols)
        st = cfg.state_path.rstrip("/")
        self.watermark_path = f"{st}/watermark"
        self.run_log_path = f"{st}/run_log"
        self.rejected_path = f"{st}/rejected_rows"
        self.journal = MergeJournal(spark, f"{st}/journal")
        #: Called with the name of every point a run passes (see ``LakeTable.merge``, and
        #: 'logged', 'watermarked'); a test that raises here stands for a job that dies there.
        self.at: Callable[[str], None] = lambda point: None

    # -- state ---------------------------------------------------------------------
    def watermark(self, start: str | None = None, end: str | None = None) -> DataFrame:
        """Current size per file; with a date range only those day partitions are read."""
        if not path_exists(self.spark, self.watermark_path):
            return self.spark.createDataFrame([], "file_key string, size bigint, modified timestamp")
        log = self.spark.read.parquet(self.watermark_path)
        if start is not None:
            log = log.where(F.col("file_date").between(F.lit(start).cast("date"),
                                                       F.lit(end or start).cast("date")))
        return current_watermark(log)

    def recover(self) -> list[str]:
        """Finish batches whose partition overwrite may have been interrupted."""
        done = []
        for batch_id, staging in self.journal.pending():
            if path_exists(self.spark, staging):
                self.table.overwrite_from(staging)
            wm = f"{staging}_watermark"
            if path_exists(self.spark, wm):
                append_log(self.spark.read.parquet(wm), self.watermark_path,
                           partition_col="file_date")
            self.journal.record(batch_id, staging, "committed")
            base = shared_dir(self.spark, "staging", batch_id)
            for path in (staging, wm, f"{base}_parsed", f"{base}_staged"):  # what the dead run left
                delete_path(self.spark, path)
            done.append(batch_id)
        return done

    def compact_state(self, before: str | dt.date) -> dict:
        """One file per closed day in the watermark log and the journal (days < before).
        Run it when no ingest is running (e.g. daily); files of a day can still grow
        during the first minutes of the next day, so ``before`` should be at most
        yesterday."""
        before = F.lit(str(before)).cast("date")
        out = {}
        for name, path, col in (("watermark", self.watermark_path, "file_date"),
                                ("journal", self.journal.path, "day")):
            if path_exists(self.spark, path):
                out[name] = LakeTable(self.spark, path, (col,)).compact(F.col(col) < before)
        return out

    # -- selection -----------------------------------------------------------------
    def changed_files(self, run_ts: str | None = None, start: str | None = None,
                      end: str | None = None) -> DataFrame:
        return self.file_actions(run_ts, start, end).where(F.col("action") != "unchanged")

    def file_actions(self, run_ts: str | None = None, start: str | None = None,
                     end: str | None = None) -> DataFrame:
        """The run's files against the watermark: unchanged, updated (grown, new), recreated."""
        if start is None:
            run = dt.datetime.fromisoformat(run_ts)
            days = str((run - dt.timedelta(hours=1)).date()), str(run.date())
        else:
            days = start, end or start
        listing = list_hourly_logs(self.spark, self.cfg.source_root, *days)
        wm = self.watermark(*days)
        if start is not None:
            sel = listing.where(F.col("file_date").between(F.lit(start).cast("date"),
                                                           F.lit(end or start).cast("date")))
            # back-fill: later hours are applied later, so they win on conflicts
            sel = sel.withColumn("load_order", F.unix_timestamp(F.col("file_hour").cast("timestamp")))
        else:
            sel = select_ingest_files(listing, run_ts, self.cfg.window_minutes)
        return file_changes(sel, wm, compare_mtime=self.cfg.compare_mtime)

    # -- run -------------------------------------------------------------------------
    def run(self, run_ts: str | None = None, start: str | None = None, end: str | None = None,
            extraction_ts: dt.datetime | None = None) -> dict:
        spark, cfg = self.spark, self.cfg
        self.recover()
        batch_id = uuid.uuid4().hex
        extraction_ts = extraction_ts or _now()
        todo = self.changed_files(run_ts, start, end) \
            .select("path", "file_key", "file_date", "size", "modified", "prev_size", "action",
                    "load_order") \
            .collect()
        if not todo:
            return {"batch_id": batch_id, "files": 0, "rows": 0, "status": "no_changes"}
        files = spark.createDataFrame([r.asDict() for r in todo],
                                      "path string, file_key string, file_date date, size bigint, "
                                      "modified timestamp, prev_size bigint, action string, "
                                      "load_order bigint")
        read = read_log(spark, [r["path"] for r in todo], cfg.sep, REQUIRED_FILE_COLUMNS,
                        kind="hourly", on_corrupt="flag")
        # Parse the lines once: typed rows + corrupt flag go to the staging area, and every
        # later step (file policy, quarantine, sequencing, counts) reads that copy.
        parsed_path = shared_dir(spark, "staging", f"{batch_id}_parsed")
        rows = read.rows.join(files.select("file_key", "load_order"), "file_key")
        tf.clean_hourly(rows, extraction_ts, keep=("path", "_corrupt")) \
            .write.mode("overwrite").parquet(parsed_path)
        parsed = spark.read.parquet(parsed_path)
        rejected = {path_key(r["path"]): r["reason"] for r in read.rejected.collect()}
        read.release()  # everything later reads the parsed copy
        if cfg.on_corrupt == "quarantine":
            good, left_out = parsed.where(~F.col("_corrupt")), parsed.where("_corrupt")
        else:  # fail_file (default): any corrupt row rejects its whole file
            files_bad = parsed.where("_corrupt").select("path").distinct()
            bad = [r["path"] for r in files_bad.collect()]  # also goes to the run log, one row per file
            if bad and cfg.on_corrupt == "raise":
                raise ValueError(f"corrupt rows in {bad}")
            rejected.update({path_key(p): "corrupt rows (ragged row or invalid UTF-8)" for p in bad})
            good, left_out = parsed.join(files_bad, "path", "left_anti"), parsed.limit(0)
        # Rows that are left out are recorded before anything is stored; a failed record
        # stops the batch.
        append_log(left_out.select(F.lit(batch_id).alias("batch_id"), "file_key", "row_pos",
                                   F.lit("corrupt row (ragged or invalid UTF-8)").alias("reason"))
                   .unionByName(good.where(F.col("time").isNull())
                                .select(F.lit(batch_id).alias("batch_id"), "file_key", "row_pos",
                                        F.lit("event time missing or invalid").alias("reason"))),
                   self.rejected_path)
        seq = tf.sequence_hourly(good.where(F.col("time").isNotNull()))
        seq = tf.zero_id_rule(seq, enabled=cfg.zero_id_rule)
        seq = mark_last_write(seq, list(cfg.keys), [F.col("load_order").desc(), F.col("row_pos").desc()])
        staged_path = shared_dir(spark, "staging", f"{batch_id}_staged")
        own = ["file_key", "load_order", "row_pos", "is_last"]
        seq.select(*tf.table_exprs(), *own).write.mode("overwrite").parquet(staged_path)
        staged = spark.read.parquet(staged_path)
        changes = self._changes(staged, [c for c in staged.columns if c not in own])
        per_file = {r["file_key"]: r["rows"] for r in changes.values()}

        last = staged.where("is_last").drop(*own)
        stats = self.table.merge(last, list(cfg.keys), cfg.merge_mode, journal=self.journal, batch_id=batch_id,
                                 commit=False, at=self.at)
        ok_files = [r for r in todo if path_key(r["path"]) not in rejected]
        now = _now()
        log_rows = [(r["file_key"], int(per_file.get(r["file_key"], 0)),
                     "error" if path_key(r["path"]) in rejected else "success",
                     (rejected.get(path_key(r["path"])) or "")[:RUN_MESSAGE_LIMIT], batch_id, now)
                    for r in todo]
        append_log(spark.createDataFrame(log_rows, "file_name string, total_registros bigint, "
                                         "status string, mensagem string, batch_id string, "
                                         "logged_at timestamp_ntz"), self.run_log_path, guarded=True)
        self.at("logged")
        if ok_files:
            stored = spark.createDataFrame([r.asDict() for r in ok_files], files.schema)
            wm = watermark_entries(stored, batch_id, now)
            if stats.get("staging"):
                wm.write.mode("overwrite").parquet(f"{stats['staging']}_watermark")
            append_log(wm, self.watermark_path, partition_col="file_date")
        self.at("watermarked")
        if stats.get("staging"):
            self.journal.record(batch_id, stats["staging"], "committed")
        # nothing needs the copies once the journal says committed
        for path in (parsed_path, staged_path, stats.get("staging"), f"{stats.get('staging')}_watermark"):
            if path and path_exists(spark, path):
                delete_path(spark, path)
        return {"batch_id": batch_id, "files": len(todo), "rows": int(sum(per_file.values())),
                "rejected_files": rejected, "rows_per_file": per_file,
                "changes": {k: {c: r[c] for c in ("staged", "inserted", "updated", "unchanged", "ignored")} for k, r in changes.items()},
                "status": "error" if rejected else "success"}

    def _changes(self, staged: DataFrame, columns: list[str]) -> dict:
        """What each file of the batch does to the table, file after file: one row a file."""
        first = self.cfg.partition_cols[0]
        ends = staged.agg(F.min(first).alias("a"), F.max(first).alias("b")).first()
        existing = self.table.touched(staged, ends["a"], ends["b"]) if self.table.exists() else staged.limit(0)
        changes = change_set(existing.select(*columns), staged, self.cfg.keys, ["load_order", "row_pos"],
                             ignore=(EXTRACTION_COLUMN, *self.cfg.partition_cols), mode=self.cfg.merge_mode)
        return {r["file_key"]: r for r in changes_per_file(changes).collect()}

