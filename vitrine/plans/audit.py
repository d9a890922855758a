"""Audit job: reconcile machine logs with stored tables for any lines and days at once.

For each configured line the job lists its log files (sizes only), keeps the files
of the audited days (plus the following day's, for rows written after midnight),
reads them by header name and turns them into (line, day, key); the table side is
read with day-partition pruning. Each line's key pairs are written once; a line that
fails stores ``error`` with its message for every day and the others still finish.
The stored pairs of all lines and days then go through one plan, the results are
upserted into the audit table keyed by (line, audited_date), and a summary with one
row per expected line and day is returned. The run fails after storing when any line
is not ``ok``.

Days: an hourly line's day D has a log when a file of D or the 00 file of D+1 exists,
a plate line's when the file of D or D+1 exists. A file rejected by its header makes
the days it may hold ``error``. Malformed rows are left out and counted per line and
day of their file (column ``malformed``).
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.clean import normalize_name
from vitrine.operators import reconcile as rc
from vitrine.plans import transform as tf
from vitrine.plans.tables import LakeTable, MergeJournal
from vitrine.session import shared_dir
from vitrine.sources.fs import delete_path
from vitrine.sources.listing import (list_hourly_logs, list_plate_logs,
                                     select_hourly_audit_files, select_plate_audit_files)
from vitrine.sources.logscan import path_key, read_log
from vitrine.spec import NOTE_LIMIT, STATUS_ERROR, LineSpec

__all__ = ["AuditLine", "AuditJob", "AuditFailed"]


class AuditFailed(RuntimeError):
    pass


@dataclass
class AuditLine:
    spec: LineSpec
    log_root: str
    table: LakeTable
    typed_keys: bool = True


def _days(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"),
                                                      F.lit(end).cast("date"))).alias("audited_date"))


class AuditJob:
    def __init__(self, spark: SparkSession, lines: list[AuditLine], results_path: str):
        self.spark, self.lines = spark, lines
        self.results = LakeTable(spark, results_path, ("audited_date",))
        # beside the table, not inside it: an interrupted overwrite of stored results is
        # finished from its staged copy before the next run
        self.journal = MergeJournal(spark, f"{results_path.rstrip('/')}_journal")
        self.recover()

    def recover(self) -> None:
        for batch_id, staging in self.journal.pending():
            self.results.finish(batch_id, staging, self.journal)

    def _files(self, ln: AuditLine, start: str, end: str) -> list:
        after = dt.date.fromisoformat(end) + dt.timedelta(1)  # rows written after midnight
        if ln.spec.kind == "plate":
            files = select_plate_audit_files(list_plate_logs(self.spark, ln.log_root, start, after), start, end)
        else:
            files = select_hourly_audit_files(list_hourly_logs(self.spark, ln.log_root, start, after), start, end)
        return files.select("path", "file_date", "file_hour").collect()

    def _days_of(self, ln: AuditLine, row) -> list[dt.date]:
        """Days whose rows a file may hold: its own, and the one before when rows written
        after midnight go there (every plate log, an hourly line's 00 file)."""
        day = row["file_date"]
        late = ln.spec.kind == "plate" or row["file_hour"].hour == 0
        return [day, day - dt.timedelta(1)] if late else [day]

    def _line_pairs(self, ln: AuditLine, files: list, start: str, end: str, path: str):
        """Write the line's key pairs to ``path``; returns rejected files and malformed rows per day."""
        spark, spec = self.spark, ln.spec
        required = ("time", "lite_id", "cap_id")
        if spec.kind == "plate":
            required = (normalize_name(spec.log_date_col), normalize_name(spec.log_key))
        read = read_log(spark, [r["path"] for r in files], spec.sep, required, kind=spec.kind,
                        on_corrupt="flag", strict_utf8=False)
        rejected = {path_key(r["path"]): r["reason"] for r in read.rejected.collect()}
        rows = read.rows.where(~F.col("_corrupt")).withColumn("line", F.lit(spec.name))
        if spec.kind == "plate":
            lk = tf.plate_log_keys(rows, *required, typed=ln.typed_keys, date_sep=spec.date_sep)
        else:
            lk = tf.hourly_log_keys(rows, typed=ln.typed_keys)
        lk = lk.where(F.col("audited_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        if not ln.table.exists():
            tr = spark.createDataFrame([], "line string, audited_date date, key string")
        elif spec.kind == "plate":
            tr = tf.plate_table_rows(ln.table.read_days(start, end), spec.name, spec.db_date_col,
                                     spec.db_key, ln.typed_keys)
        else:
            tr = tf.hourly_table_rows(ln.table.read_days(start, end), spec.name)
        rc.key_pairs(lk, tr).write.mode("overwrite").parquet(path)
        bad = read.rows.where("_corrupt").groupBy("file_date").agg(F.count(F.lit(1)).alias("n")).collect()
        read.release()
        return rejected, {r["file_date"]: r["n"] for r in bad}

    def _line(self, ln: AuditLine, start: str, end: str, path: str) -> tuple[list, bool]:
        """The line's grid (line, day, has_log, no-log note, error, malformed), and whether
        its pairs were written. A failure is kept as the error of every day."""
        spec = ln.spec
        days = [dt.date.fromisoformat(start) + dt.timedelta(n) for n in
                range((dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1)]
        try:
            files = self._files(ln, start, end)
            rejected, malformed = self._line_pairs(ln, files, start, end, path)
        except Exception as exc:  # noqa: BLE001 - stored as the line's result; other lines go on
            note = f"Audit error: {exc}"[:NOTE_LIMIT]
            return [(spec.name, d, True, spec.no_log_note, note, 0) for d in days], False
        have, errors = set(), {}
        for r in files:
            have.update(self._days_of(ln, r))
            reason = rejected.get(path_key(r["path"]))
            for d in self._days_of(ln, r) if reason else ():
                errors.setdefault(d, f"Audit error: {r['path']}: {reason}"[:NOTE_LIMIT])
        return [(spec.name, d, d in have, spec.no_log_note, errors.get(d), malformed.get(d, 0))
                for d in days], True

    def run(self, start: str, end: str | None = None, fail_on_divergence: bool = True
            ) -> DataFrame:
        end = end or start
        spark = self.spark
        self.recover()  # this object's own last run may have died inside the overwrite
        base = shared_dir(spark, "staging", f"audit_{uuid.uuid4().hex}")
        grid, written = [], []
        for k, ln in enumerate(self.lines):
            rows, ok = self._line(ln, start, end, f"{base}/pairs_{k}")
            grid.extend(rows)
            written += [f"{base}/pairs_{k}"] if ok else []
        shape = "line string, audited_date date, key string, in_log boolean, n_db bigint"
        pairs = spark.read.schema(shape).parquet(*written) if written else spark.createDataFrame([], shape)
        labels = spark.createDataFrame([(ln.spec.name, ln.spec.key_label) for ln in self.lines],
                                       "line string, key_label string")
        expected = spark.createDataFrame(grid, "line string, audited_date date, has_log boolean, "
                                         "no_log_note string, error string, malformed bigint")
        res = rc.audit_results_of_pairs(pairs, labels, expected.drop("error", "malformed"))
        failed = F.col("error").isNotNull()
        res = res.join(expected.select("line", "audited_date", "error", "malformed"), ["line", "audited_date"])
        res = res.select(
            "line", "audited_date",
            *[F.when(failed, F.lit(0).cast("bigint")).otherwise(F.col(c)).alias(c) for c in ("total_log", "total_db", "divergence")],
            F.when(failed, F.lit("")).otherwise(F.col("ids_missing")).alias("ids_missing"),
            F.when(failed, F.lit(STATUS_ERROR)).otherwise(F.col("status")).alias("status"),
            F.coalesce("error", "note").alias("note"),
            *[F.when(failed, F.lit(0).cast("bigint")).otherwise(F.col(c)).alias(c) for c in ("distinct_db", "n_missing", "n_extra")],
            "malformed", F.current_timestamp().cast("timestamp_ntz").alias("audited_at"))
        # Materialise once (one row per line and day): the merge reads its input several
        # times (touched days, count, rows) and must not re-run the audit for each.
        res.write.mode("overwrite").parquet(f"{base}/results")
        self.results.merge(spark.read.parquet(f"{base}/results"), ["line", "audited_date"], journal=self.journal)
        delete_path(spark, base)
        stored = self.results.read_days(start, end, day_col="audited_date")
        exp = rc.expected_lines(_days(spark, start, end), [ln.spec.name for ln in self.lines])
        summary = rc.audit_summary(stored, exp)
        if fail_on_divergence:
            bad = summary.where(F.col("status") != "ok").select("line", "audited_date", "status").collect()
            if bad:
                raise AuditFailed(f"audit {start}..{end}: divergences in {[tuple(r) for r in bad]}")
        return summary
