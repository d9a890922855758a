"""Day-partitioned Parquet tables with keyed merges and day retention.

A merge never rewrites more than the partitions the batch touches:

1. the batch's first and last day are found;
2. the existing rows between them are read (static partition pruning) and joined to the
   batch's distinct partitions;
3. ``upsert``/``insert_ignore`` merge them with the batch;
4. the merged partitions are written to a staging folder in the shared area
   (this also cuts the lineage, so the final write does not read the table it
   overwrites);
5. the staging copy replaces the touched partitions of the table with dynamic
   partition overwrite.

If a job dies in step 5, the staging copy still holds the complete merged
partitions; ``MergeJournal`` replays step 5 from it before the next batch.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.merge import insert_ignore, upsert
from vitrine.session import shared_dir
from vitrine.sources.fs import delete_path, glob_paths, path_exists

__all__ = ["LakeTable", "MergeJournal", "append_log", "path_exists", "delete_path"]

# Folder of rows whose partition column is NULL.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Tasks that may share one partition's rows when it is written.
WRITE_SALTS = 8


def append_log(df: DataFrame, path: str, guarded: bool = False, partition_col: str | None = None
               ) -> bool:
    """Append rows to an append-only Parquet log (optionally day-partitioned, so readers
    prune to the days they need); with ``guarded`` a failure is reported instead of
    raised (run logs must never stop a load)."""
    try:
        w = df.write.mode("append")
        if partition_col:
            w = w.partitionBy(partition_col)
        w.parquet(path)
        return True
    except Exception as exc:  # noqa: BLE001
        if not guarded:
            raise
        print(f"log append to {path} failed (ignored): {str(exc)[:2000]}")
        return False


@dataclass
class LakeTable:
    spark: SparkSession
    path: str
    partition_cols: tuple[str, ...] = ("event_date",)

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def read_days(self, start, end, day_col: str = "event_date") -> DataFrame:
        """Rows of the days [start, end]. Where the day is the first partition column, only the
        folders of those days are listed (one look at the table's own folder finds them)."""
        days = self.read() if day_col != self.partition_cols[0] else self._folders(str(start), str(end))
        return days.where(F.col(day_col).between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")))

    def _folders(self, low: str, high: str, nulls: bool = False) -> DataFrame:
        """The table limited to first-level partitions with a day from ``low`` to ``high``."""
        mark = f"{self.partition_cols[0]}="
        keep = []
        for path in glob_paths(self.spark, f"{self.path.rstrip('/')}/{mark}*"):
            value = path.rstrip("/").rsplit(mark, 1)[1]
            if low <= value <= high or (nulls and value == NULL_PARTITION):
                keep.append(path)
        if not any(not p.endswith(NULL_PARTITION) for p in keep):
            return self.read()  # no such day: the schema comes from the whole table
        return self.spark.read.option("basePath", self.path).parquet(*keep)

    def merge(self, staged: DataFrame, keys, mode: str = "update", staging: str | None = None,
              journal: "MergeJournal | None" = None, batch_id: str | None = None,
              commit: bool = True, at: Callable[[str], None] | None = None) -> dict:
        """Merge a (materialised) batch into the touched partitions. Returns stats.

        The table is read between the batch's smallest and largest value of the first
        partition column (static pruning) and joined to the batch's distinct partitions, so
        neither a list of partitions nor a predicate per partition is built. With a journal
        and ``commit`` the batch is recorded as committed and its staged copy removed;
        otherwise the caller does both after its own bookkeeping. ``at`` is called with the name
        of every point passed: 'staged' (the journal knows the copy), 'overwritten', 'committed'."""
        spark = self.spark
        batch_id = batch_id or uuid.uuid4().hex
        staging = staging or shared_dir(spark, "staging", batch_id)
        cols = list(self.partition_cols)
        first = cols[0]
        bounds = staged.agg(F.min(first).alias("a"), F.max(first).alias("b"), F.count(F.lit(1)).alias("n"),
                            F.count_distinct(F.struct(*cols)).alias("p")).first()
        if not bounds["n"]:
            return {"batch_id": batch_id, "staged_rows": 0, "partitions": 0}
        at = at or (lambda point: None)
        if self.exists():
            existing = self.touched(staged, bounds["a"], bounds["b"]).select(*staged.columns)
            merged = (upsert if mode == "update" else insert_ignore)(existing, staged, keys)
        else:
            merged = staged
        # Hash on the partition columns and a bounded salt of the keys: few files per
        # partition, and a partition that holds most of the batch is shared by several tasks.
        salt = F.pmod(F.xxhash64(*keys), F.lit(WRITE_SALTS))
        merged = merged.repartition(*cols, salt)
        merged.write.mode("overwrite").partitionBy(*cols).parquet(staging)
        if journal is not None:
            journal.record(batch_id, staging, "staged")
        at("staged")
        self.overwrite_from(staging)
        at("overwritten")
        if commit:
            if journal is not None:
                journal.record(batch_id, staging, "committed")
            at("committed")
            delete_path(spark, staging)
        return {"batch_id": batch_id, "staged_rows": bounds["n"], "partitions": bounds["p"],
                "staging": staging}

    def touched(self, staged: DataFrame, low, high) -> DataFrame:
        """Stored rows of the partitions that ``staged`` holds rows of; ``low`` and ``high``: its
        smallest and largest value of the first partition column."""
        cols = list(self.partition_cols)
        wanted = staged.select(*[F.col(c).alias(f"_t_{c}") for c in cols]).distinct()
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in cols])
        near = F.col(cols[0]).between(F.lit(low), F.lit(high)) | F.col(cols[0]).isNull()
        is_day = type(low) is dt.date
        stored = self._folders(str(low), str(high), nulls=True) if is_day else self.read()
        return stored.where(near).join(wanted, same, "left_semi")

    def finish(self, batch_id: str, staging: str, journal: "MergeJournal") -> None:
        """Complete an interrupted overwrite from its staged copy."""
        if path_exists(self.spark, staging):
            self.overwrite_from(staging)
        journal.record(batch_id, staging, "committed")
        delete_path(self.spark, staging)

    def overwrite_from(self, staging: str) -> None:
        """Replace the partitions present in ``staging`` (dynamic partition overwrite)."""
        (self.spark.read.parquet(staging).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .partitionBy(*self.partition_cols).parquet(self.path))

    def compact(self, where, journal: "MergeJournal | None" = None) -> int:
        """Rewrite the partitions selected by ``where`` (a predicate on partition columns)
        as few files, through a staging copy. For closed partitions of append-only logs,
        which collect one small file per batch. Returns rows rewritten."""
        part = self.read().where(where)
        n = part.count()
        if n == 0:
            return 0
        batch_id = f"compact_{uuid.uuid4().hex}"
        staging = shared_dir(self.spark, "staging", batch_id)
        others = [c for c in part.columns if c not in self.partition_cols]
        salt = F.pmod(F.xxhash64(*others), F.lit(WRITE_SALTS))
        part.repartition(*self.partition_cols, salt).write.mode("overwrite") \
            .partitionBy(*self.partition_cols).parquet(staging)
        if journal is not None:
            journal.record(batch_id, staging, "staged")
        self.overwrite_from(staging)
        if journal is not None:
            journal.record(batch_id, staging, "committed")
        delete_path(self.spark, staging)
        return n

    def drop_days(self, days: list[dt.date], day_col: str = "event_date") -> list[dt.date]:
        """Remove whole day partitions (retention). Returns the days removed."""
        gone = []
        for d in days:
            if delete_path(self.spark, f"{self.path.rstrip('/')}/{day_col}={d}"):
                gone.append(d)
        return gone


@dataclass
class MergeJournal:
    """Append-only record of merge batches: 'staged' then 'committed'."""

    spark: SparkSession
    path: str

    def record(self, batch_id: str, staging: str, state: str) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = self.spark.createDataFrame([(batch_id, staging, state, now, now.date())],
                                         "batch_id string, staging string, state string, "
                                         "at timestamp_ntz, day date")
        row.write.mode("append").partitionBy("day").parquet(self.path)

    def pending(self) -> list[tuple[str, str]]:
        """Batches staged but never committed, whatever their age: their overwrite may be
        incomplete. (Compaction keeps the journal's closed days small.)"""
        if not path_exists(self.spark, self.path):
            return []
        j = self.spark.read.parquet(self.path)
        done = j.where(F.col("state") == "committed").select("batch_id")
        pend = j.where(F.col("state") == "staged").join(done, "batch_id", "left_anti")
        return [(r["batch_id"], r["staging"]) for r in pend.collect()]
