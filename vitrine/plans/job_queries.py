"""Queries that run the jobs themselves -- readers over written log files, ingest, merge, audit,
archive -- and read back what they stored. Logs, tables and faults are all derived from the
driver tables; every query works in fresh folders of the shared area.

The events play machine logs of one file a day: an hourly log under hour 00, or a plate log.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import archive as arch
from vitrine.operators.merge import change_set, changes_per_file
from vitrine.operators.reconcile import expected_lines, audit_summary, key_pairs, reconcile_counts
from vitrine.plans import transform as tf
from vitrine.plans.archive import archive_quarter
from vitrine.plans.audit import AuditJob, AuditLine
from vitrine.plans.ingest import IngestConfig, IngestJob
from vitrine.plans.log_files import log_line, write_hourly_logs, write_plate_logs
from vitrine.plans.tables import LakeTable, MergeJournal
from vitrine.session import fresh_dir
from vitrine.sources.logscan import read_log
from vitrine.spec import LINES, REQUIRED_FILE_COLUMNS

ARCHIVE_AS_OF = "2000-04-10"
#: The day of the archived quarter whose copy gets one changed value.
CHANGED_DAY = "2000-02-15"
RUN_AT = dt.datetime(2024, 2, 1)
EXISTING_BEFORE, STAGED_FROM = "2000-01-01", "1999-07-01"


class Died(RuntimeError):
    """Stands for a job that was lost at a point."""


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _orders(spark, d) -> tuple[DataFrame, DataFrame]:
    od = _t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("order_day"), "o_orderpriority")
    existing = od.where(F.col("order_day") < F.lit(EXISTING_BEFORE).cast("date")).withColumn("loaded_from", F.lit("existing"))
    staged = (od.where(F.col("order_day") >= F.lit(STAGED_FROM).cast("date"))
              .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(100.0)).withColumn("loaded_from", F.lit("staged")))
    return existing, staged


# ---------------------------------------------------------------------------
# Header-mapped read and row policy
# ---------------------------------------------------------------------------

def q_header_mapped(spark, d):
    """Three firmware layouts in one read: the plain one, one reversed with a note column, one
    with quoted fields and other spellings."""
    ev = _t(spark, d, "events")
    day = F.to_date("ts")
    at = F.date_format("ts", "HH:mm:ss")
    layout = F.dayofmonth("ts") % 3
    plain = log_line(";", at, "user_id", "event_id", "event_type")
    turned = log_line(";", F.lit("note; to skip").substr(1, 4), "event_type", "event_id", "user_id", at)
    quoted = log_line(";", F.concat(F.lit('"'), F.col("event_type"), F.lit(';""x"""')), at, F.concat(F.lit('"'), F.col("user_id"), F.lit('"')), "event_id")
    hour = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("file_hour")
    rows = ev.select(hour, F.col("event_id").alias("place"), F.when(layout == 0, plain).when(layout == 1, turned).otherwise(quoted).alias("line"))
    heads = ev.select(day.alias("day")).distinct().select(
        F.col("day").cast("timestamp_ntz").alias("file_hour"), F.lit(-1).cast("long").alias("place"),
        F.when(F.dayofmonth("day") % 3 == 0, "Time;Lite id;Cap id;Total Result").when(F.dayofmonth("day") % 3 == 1, "Note;TOTAL_RESULT;cap-id;lite  id;time")
        .otherwise('"Total result";"TIME";" Lite Id ";Cap.ID').alias("line"))
    paths = write_hourly_logs(rows.unionByName(heads), fresh_dir(spark, "catalog", "header_mapped"))
    got = read_log(spark, paths, ";", ("time", "lite_id", "cap_id", "total_result")).rows
    return got.select(F.date_format("file_date", "yyyy-MM-dd").alias("file_day"), "time", F.col("lite_id").alias("user_id"),
                      F.col("cap_id").alias("event_id"), F.col("total_result").alias("event_type"))


HEADER_MAPPED_SQL = """
    SELECT strftime(ts, '%Y-%m-%d') AS file_day, strftime(ts, '%H:%M:%S') AS time, CAST(user_id AS VARCHAR) AS user_id,
           CAST(event_id AS VARCHAR) AS event_id, CASE WHEN day(ts) % 3 = 2 THEN event_type || ';"x"' ELSE event_type END AS event_type FROM events"""


def q_log_policy(spark, d):
    """Plate logs with every kind of bad row and file, against a table with NULL keys: what is
    kept, dropped, flagged, rejected and counted, per day of the file."""
    ev = _t(spark, d, "events")
    e = F.col("event_id")
    at, key = F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSSSSS"), e.cast("string")
    line = (F.when(e % 23 == 1, F.concat(F.lit("  \t"), key, F.lit("\tOK")))                       # blank time
            .when(e % 23 == 2, F.concat(at, F.lit("\t   \tOK")))                                   # blank ID
            .when(e % 23 == 3, F.concat(F.lit("2024/13/45 99:00:00\t"), key, F.lit("\tOK")))       # no such time
            .when(e % 23 == 4, F.concat(at, F.lit("\t"), key))                                     # a field too few
            .when(e % 23 == 5, F.concat(at, F.lit("\t"), key, F.lit("\tOK\tmore")))                # a field too many
            .when(e % 23 == 6, F.concat(at, F.lit("\t "), key, F.lit(".0 \tOK")))                  # ID with decimals
            .otherwise(F.concat(at, F.lit("\t"), key, F.lit("\tOK"))))
    rows = ev.select(F.to_date("ts").alias("file_date"), e.alias("place"), line.alias("line"))
    heads = rows.select("file_date").distinct().select(
        "file_date", F.lit(-1).cast("long").alias("place"), F.when(F.dayofmonth("file_date") % 10 == 4, "Date\tPanel\tResult")
        .otherwise("Date\tGrpID\tResult").alias("line"))
    root = fresh_dir(spark, "catalog", "log_policy")
    read = read_log(spark, write_plate_logs(rows.unionByName(heads), root), "\t", ("date", "grpid"), kind="plate", on_corrupt="flag")
    kept = read.rows.where(~F.col("_corrupt")).withColumn("line", F.lit("MIRROR1"))
    keys = tf.plate_log_keys(kept, "date", "grpid")
    stored = ev.where(e % 29 != 7).select("ts", F.when(e % 31 != 8, e).alias("grpid"))
    pairs = reconcile_counts(key_pairs(keys, tf.plate_table_rows(stored, "MIRROR1", "ts", "grpid"))).drop("line")
    files = (read.rows.groupBy(F.col("file_date").alias("audited_date")).agg(F.count(F.lit(1)).alias("file_rows"), F.count_if("_corrupt").cast("bigint").alias("corrupt_rows")))
    rejected = read.rejected.select(F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})-PlateLog", 1).cast("date").alias("audited_date"), F.lit(True).alias("rejected"))
    zero = F.lit(0).cast("bigint")
    return (pairs.join(files, "audited_date", "left").join(rejected, "audited_date", "left")
            .select("audited_date", "total_log", "total_db", "distinct_db", "n_missing", "n_extra", F.coalesce("file_rows", zero).alias("file_rows"),
                    F.coalesce("corrupt_rows", zero).alias("corrupt_rows"), F.coalesce("rejected", F.lit(False)).alias("rejected")))


LOG_POLICY_SQL = """
    WITH e AS (SELECT event_id AS id, CAST(ts AS DATE) AS day, event_id % 23 AS kind, day(ts) % 10 = 4 AS wrong FROM events),
    log AS (SELECT day, id FROM e WHERE NOT wrong AND kind NOT IN (1, 2, 3, 4, 5)),
    tab AS (SELECT day, CASE WHEN id % 31 <> 8 THEN id END AS id FROM e WHERE id % 29 <> 7),
    days AS (SELECT day, count(*) AS n, count(*) FILTER (WHERE kind IN (4, 5)) AS bad, bool_or(wrong) AS wrong FROM e GROUP BY day)
    SELECT day AS audited_date, (SELECT count(*) FROM log WHERE log.day = days.day) AS total_log,
           (SELECT count(*) FROM tab WHERE tab.day = days.day) AS total_db,
           (SELECT count(id) FROM tab WHERE tab.day = days.day) AS distinct_db,
           (SELECT count(*) FROM log WHERE log.day = days.day AND id NOT IN (SELECT id FROM tab WHERE id IS NOT NULL)) AS n_missing,
           (SELECT count(*) FROM tab WHERE tab.day = days.day AND id IS NOT NULL AND id NOT IN (SELECT id FROM log)) AS n_extra,
           CASE WHEN wrong THEN 0 ELSE n END AS file_rows, CASE WHEN wrong THEN 0 ELSE bad END AS corrupt_rows, wrong AS rejected
    FROM days"""


# ---------------------------------------------------------------------------
# Ingest, merge
# ---------------------------------------------------------------------------

def q_staged_changes(spark, d):
    """Two files that share keys, over a table that has some of them: rows by what they did."""
    existing, staged = _orders(spark, d)
    k = F.col("o_orderkey")
    first = staged.withColumn("file_key", F.lit("first")).withColumn("load_order", F.lit(0)) \
        .withColumn("o_totalprice", F.when(k % 5 == 0, F.col("o_totalprice") - 100.0).otherwise(F.col("o_totalprice")))
    second = staged.where(k % 3 == 0).withColumn("file_key", F.lit("second")).withColumn("load_order", F.lit(1))
    rows = change_set(existing, first.unionByName(second), ["o_orderkey"], ["load_order"], ignore=("loaded_from",))
    return changes_per_file(rows).select("file_key", "staged", "inserted", "updated", "rows", (F.col("unchanged") > 0).alias("some_unchanged"))


STAGED_CHANGES_SQL = f"""
    WITH od AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_totalprice AS p FROM orders),
    st AS (SELECT k, day < DATE '{EXISTING_BEFORE}' AS known, p, CASE WHEN k % 5 = 0 THEN p + 100.0 - 100.0 ELSE p + 100.0 END AS p1, p + 100.0 AS p2
           FROM od WHERE day >= DATE '{STAGED_FROM}'),
    c AS (SELECT 'first' AS file_key, CASE WHEN NOT known THEN 'inserted' WHEN p = p1 THEN 'unchanged' ELSE 'updated' END AS change FROM st
          UNION ALL SELECT 'second', CASE WHEN p1 = p2 THEN 'unchanged' ELSE 'updated' END FROM st WHERE k % 3 = 0)
    SELECT file_key, count(*) AS staged, count(*) FILTER (WHERE change = 'inserted') AS inserted,
           count(*) FILTER (WHERE change = 'updated') AS updated, count(*) AS rows,
           count(*) FILTER (WHERE change = 'unchanged') > 0 AS some_unchanged FROM c GROUP BY file_key"""


def _share() -> Column:
    """Partition of an order: one holds three fifths of all rows."""
    return F.when(F.col("o_orderkey") % 10 < 6, F.lit("most")).otherwise(F.col("o_orderpriority"))


def q_merge_partitions(spark, d):
    """A merge into a stored table by partitions, read back."""
    existing, staged = (x.withColumn("share", _share()) for x in _orders(spark, d))
    table = LakeTable(spark, fresh_dir(spark, "catalog", "merge"), ("share",))
    journal = MergeJournal(spark, fresh_dir(spark, "catalog", "merge_journal"))
    table.merge(existing, ["o_orderkey"], journal=journal)
    table.merge(staged, ["o_orderkey"], journal=journal)
    return table.read()


_SHARE_SQL = "CASE WHEN o_orderkey % 10 < 6 THEN 'most' ELSE o_orderpriority END"
MERGE_PARTITIONS_SQL = f"""
    WITH od AS (SELECT o_orderkey, o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS order_day, o_orderpriority, {_SHARE_SQL} AS share FROM orders)
    SELECT o_orderkey, o_custkey, CASE WHEN order_day >= DATE '{STAGED_FROM}' THEN o_totalprice + 100.0 ELSE o_totalprice END AS o_totalprice,
           order_day, o_orderpriority, CASE WHEN order_day >= DATE '{STAGED_FROM}' THEN 'staged' ELSE 'existing' END AS loaded_from, share
    FROM od"""


def q_crash_restart(spark, d):
    """The same merge lost at three points and restarted: rows and contents of each table."""
    existing, staged = (x.withColumn("share", _share()) for x in _orders(spark, d))
    out = []
    for point in ("staged", "overwritten", "committed"):
        table = LakeTable(spark, fresh_dir(spark, "catalog", "crash"), ("share",))
        journal = MergeJournal(spark, fresh_dir(spark, "catalog", "crash_journal"))
        table.merge(existing, ["o_orderkey"], journal=journal)

        def die(name, point=point):
            if name == point:
                raise Died(name)

        try:
            table.merge(staged, ["o_orderkey"], journal=journal, at=die)
        except Died:
            pass
        for batch, staging in journal.pending():
            table.finish(batch, staging, journal)
        table.merge(staged, ["o_orderkey"], journal=journal)
        out.append(table.read().withColumn("lost_at", F.lit(point)))
    rows = reduce(lambda a, b: a.unionByName(b), out)
    return rows.groupBy("lost_at", "share", "loaded_from").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"), F.sum("o_orderkey").alias("keys"))


CRASH_RESTART_SQL = f"""
    WITH m AS ({MERGE_PARTITIONS_SQL}), p AS (SELECT unnest(['staged', 'overwritten', 'committed']) AS lost_at)
    SELECT lost_at, share, loaded_from, count(*) AS rows, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents,
           CAST(sum(o_orderkey) AS BIGINT) AS keys FROM m, p GROUP BY ALL"""


def _machine_logs(ev: DataFrame, keep: Column, ragged: Column, root: str) -> None:
    """Hourly logs of one file a day with all columns; ``ragged`` days hold a half row."""
    fields = {"time": F.date_format("ts", "HH:mm:ss"), "lite_id": F.col("user_id"), "cap_id": F.floor("value").cast("bigint"),
              "total_result": F.col("event_type"), "position": F.col("value")}
    line = log_line(";", *[fields.get(c, F.lit("1.#INF")) for c in REQUIRED_FILE_COLUMNS])
    hour = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("file_hour")
    rows = ev.where(keep).select(hour, F.col("event_id").alias("place"), line.alias("line"))
    days = ev.select(hour).distinct()
    heads = days.select("file_hour", F.lit(-1).cast("long").alias("place"), F.lit(";".join(REQUIRED_FILE_COLUMNS)).alias("line"))
    half = days.where(ragged).select("file_hour", F.lit(1 << 40).alias("place"), F.lit("00:00:00;1").alias("line"))
    write_hourly_logs(rows.unionByName(heads).unionByName(half), root)


def q_ingest_commits(spark, d):
    """Two ingest runs: in between files stay, grow, shrink, or get a half row (by day % 4). Per
    file: what the second run saw, whether it committed the new size, and the table's rows."""
    ev = _t(spark, d, "events")
    base = fresh_dir(spark, "catalog", "ingest_commits")
    days = ev.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    if days[0] is None:
        return spark.createDataFrame([], "file_key string, action string, rejected boolean, committed boolean, rows bigint")
    start, end = str(days[0]), str(days[1])
    case, even = F.dayofmonth("ts") % 4, F.col("event_id") % 2 == 0
    job = IngestJob(spark, IngestConfig(f"{base}/logs", f"{base}/table", f"{base}/state", partition_cols=("event_date",)))
    _machine_logs(ev, case.isin(0, 2) | even, F.lit(False), f"{base}/logs")
    job.run(start=start, end=end, extraction_ts=RUN_AT)
    _machine_logs(ev, (case != 2) | even, F.dayofmonth("file_hour") % 4 == 3, f"{base}/logs")
    seen = job.file_actions(start=start, end=end).select("file_key", "action", "size", "file_date", "path").collect()
    out = job.run(start=start, end=end, extraction_ts=RUN_AT)
    again = IngestJob(spark, job.cfg)  # another process: everything it knows is stored
    sizes = again.watermark(start, end).select("file_key", F.col("size").alias("committed_size"))
    files = spark.createDataFrame([(r["file_key"], r["action"], r["size"], r["file_date"]) for r in seen], "file_key string, action string, size bigint, file_date date")
    log = spark.read.parquet(again.run_log_path).where(F.col("batch_id") == out["batch_id"]).select(F.col("file_name").alias("file_key"), (F.col("status") == "error").alias("rejected"))
    rows = again.table.read().groupBy(F.col("event_date").alias("file_date")).agg(F.count(F.lit(1)).alias("rows"))
    return (files.join(sizes, "file_key", "left").join(log, "file_key", "left").join(rows, "file_date", "left")
            .select("file_key", "action", F.coalesce("rejected", F.lit(False)).alias("rejected"), (F.col("size") == F.col("committed_size")).alias("committed"), "rows"))


INGEST_COMMITS_SQL = """
    WITH g AS (SELECT CAST(ts AS DATE) AS day, user_id, floor(value) AS cap, strftime(ts, '%H:%M:%S') AS t,
                      count(*) AS whole, count(*) FILTER (WHERE event_id % 2 = 0) AS half FROM events GROUP BY ALL),
    r AS (SELECT day, sum(CASE WHEN day(day) % 4 = 3 THEN half ELSE whole END) AS rows FROM g GROUP BY day)
    SELECT 'watermark_cut2_' || strftime(day, '%Y%m%d') || '_00' AS file_key,
           CASE day(day) % 4 WHEN 0 THEN 'unchanged' WHEN 2 THEN 'recreated' ELSE 'updated' END AS action,
           day(day) % 4 = 3 AS rejected, day(day) % 4 <> 3 AS committed, CAST(rows AS BIGINT) AS rows FROM r"""


# ---------------------------------------------------------------------------
# Audit
# ---------------------------------------------------------------------------

class _BrokenTable(LakeTable):
    """A table whose store cannot be read: its line's audit fails, the others go on."""

    def exists(self) -> bool:
        return True

    def read(self) -> DataFrame:
        raise OSError("store not reachable")


def q_audit_job(spark, d):
    """The audit job over all days of three lines, then the summary in its order: a plate line
    whose days are complete, lack table rows, lack log rows, have no log or a wrong header (by
    day % 10); an hourly line against the table an ingest made; a line whose table fails; and a
    line that was never run."""
    ev = _t(spark, d, "events")
    base = fresh_dir(spark, "catalog", "audit_job")
    days = ev.agg(F.min("ts").cast("date"), F.max("ts").cast("date")).first()
    if days[0] is None:
        return spark.createDataFrame([], "place bigint, line string, audited_date date, total_log bigint, total_db bigint, divergence bigint, status string, day_failed boolean")
    start, end = str(days[0]), str(days[1])
    e, n = F.col("event_id"), F.dayofmonth("ts") % 10
    rows = ev.where(~n.isin(5, 6) & ((n != 2) | (e % 4 != 0))).select(
        F.to_date("ts").alias("file_date"), e.alias("place"), log_line("\t", F.date_format("ts", "yyyy/MM/dd HH:mm:ss"), e).alias("line"))
    heads = rows.select("file_date").distinct().select("file_date", F.lit(-1).cast("long").alias("place"),
                                                      F.when(F.dayofmonth("file_date") % 10 == 9, "Date\tPanel").otherwise("Date\tGrpID").alias("line"))
    write_plate_logs(rows.unionByName(heads), f"{base}/mirror1")
    stored = LakeTable(spark, f"{base}/table_mirror1")
    ev.where((n != 1) | (e % 5 != 0)).select(e.alias("grpid"), F.col("ts").alias("date"), F.to_date("ts").alias("event_date")) \
        .write.partitionBy("event_date").parquet(stored.path)
    _machine_logs(ev, F.lit(True), F.lit(False), f"{base}/cut2")
    ingest = IngestJob(spark, IngestConfig(f"{base}/cut2", f"{base}/table_cut2", f"{base}/state", partition_cols=("event_date",), zero_id_rule=True))
    ingest.run(start=start, end=end, extraction_ts=RUN_AT)
    job = AuditJob(spark, [AuditLine(LINES["MIRROR1"], f"{base}/mirror1", stored), AuditLine(LINES["CUT2"], f"{base}/cut2", ingest.table),
                           AuditLine(LINES["CUT1"], f"{base}/mirror1", _BrokenTable(spark, f"{base}/none"))], f"{base}/results")
    job.run(start, end, fail_on_divergence=False)
    results = LakeTable(spark, job.results.path, ("audited_date",)).read()  # what was stored, not what run() returned
    summary = audit_summary(results, expected_lines(results.select("audited_date").distinct(), ["MIRROR1", "CUT1", "CUT2", "MIRROR2"]))
    ordered = [tuple(r) for r in summary.select("line", "audited_date", "total_log", "total_db", "divergence", "status", "day_failed").collect()]
    return spark.createDataFrame([(k, *r) for k, r in enumerate(ordered)],  # one row per line and day, in the summary's own order
                                 "place bigint, line string, audited_date date, total_log bigint, total_db bigint, divergence bigint, status string, day_failed boolean")


AUDIT_JOB_SQL = """
    WITH e AS (SELECT CAST(ts AS DATE) AS day, event_id AS id, user_id, day(ts) % 10 AS n FROM events),
    days AS (SELECT DISTINCT day FROM e),
    files AS (SELECT DISTINCT day, n = 9 AS wrong FROM e WHERE n NOT IN (5, 6)),
    m AS (SELECT d.day, EXISTS (SELECT 1 FROM files f WHERE f.day IN (d.day, CAST(d.day + 1 AS DATE))) AS has_log,
                 EXISTS (SELECT 1 FROM files f WHERE f.wrong AND f.day IN (d.day, CAST(d.day + 1 AS DATE))) AS wrong,
                 (SELECT count(*) FROM e WHERE e.day = d.day AND n NOT IN (5, 6, 9) AND (n <> 2 OR id % 4 <> 0)) AS in_log,
                 (SELECT count(*) FROM e WHERE e.day = d.day AND (n <> 1 OR id % 5 <> 0)) AS in_db FROM days d),
    mirror1 AS (SELECT 'MIRROR1' AS line, day, CASE WHEN wrong OR NOT has_log THEN 0 ELSE in_log END AS total_log,
                       CASE WHEN wrong OR NOT has_log THEN 0 ELSE in_db END AS total_db,
                       CASE WHEN wrong THEN 'error' WHEN NOT has_log THEN 'no_log' WHEN in_log = in_db THEN 'ok'
                            WHEN in_log > in_db THEN 'missing_in_db' ELSE 'excess_in_db' END AS status FROM m),
    cut2 AS (SELECT 'CUT2' AS line, day, count(*) AS total_log, count(*) FILTER (WHERE user_id <> 0) AS total_db,
                    CASE WHEN count(*) FILTER (WHERE user_id = 0) = 0 THEN 'ok' ELSE 'missing_in_db' END AS status FROM e GROUP BY day),
    every AS (SELECT * FROM mirror1 UNION ALL SELECT * FROM cut2
              UNION ALL SELECT 'CUT1', day, 0, 0, 'error' FROM days UNION ALL SELECT 'MIRROR2', day, NULL, NULL, 'no_result' FROM days)
    SELECT row_number() OVER (ORDER BY day, line) - 1 AS place, line, day AS audited_date, CAST(total_log AS BIGINT) AS total_log,
           CAST(total_db AS BIGINT) AS total_db, CAST(total_log - total_db AS BIGINT) AS divergence, status, true AS day_failed FROM every"""


# ---------------------------------------------------------------------------
# Archive
# ---------------------------------------------------------------------------

def _archived(spark, d, changed: bool = False, by_day: bool = True):
    """The archive job over a stored copy of orders: (table, report, written archive)."""
    base = fresh_dir(spark, "catalog", "archive")
    rows = _t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    if by_day:  # dealt by day over a fixed number of tasks, so one task does not make all folders
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows.repartition(tasks, "event_date").write.partitionBy("event_date").parquet(f"{base}/orders")
    else:
        rows.write.parquet(f"{base}/orders")
    table = LakeTable(spark, f"{base}/orders")

    def change(path: str) -> None:
        """One value of one day's copy becomes another; the number of rows stays."""
        day = F.col("event_date") == F.lit(CHANGED_DAY).cast("date")
        copy = spark.read.parquet(path).where(day)
        least = copy.agg(F.min("o_orderkey")).first()[0]
        aside = fresh_dir(spark, "catalog", "archive_changed")
        copy.withColumn("o_orderkey", F.when(F.col("o_orderkey") == least, -least).otherwise(F.col("o_orderkey"))).write.partitionBy("event_date").parquet(aside)
        spark.read.parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)

    report = archive_quarter(spark, table, "orders", f"{base}/archive", ARCHIVE_AS_OF, drop=by_day, after_write=change if changed else None)
    return table, report, spark.read.parquet(report["path"])


def q_archive_totals(spark, d):
    _, report, written = _archived(spark, d, by_day=False)
    return written.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("event_date").alias("partitions")).withColumn("period", F.lit(report["period"]))


def q_archive_validate(spark, d):
    """Source against the written archive, per day; one day's copy was changed after writing."""
    _, _, written = _archived(spark, d, changed=True, by_day=False)
    source = _t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("event_date"))
    return arch.validate_counts(arch.archive_scan(source, *arch.quarter_range(ARCHIVE_AS_OF)), written)


def q_retention_keep(spark, d):
    """What the table holds after the verified day partitions were dropped: the day whose copy
    was changed stays."""
    return _archived(spark, d, changed=True)[0].read().select("o_orderkey", "event_date")


def q_retention_counts(spark, d):
    _, report, _ = _archived(spark, d)
    return spark.createDataFrame([(dt.date.fromisoformat(k), n) for k, n in report["deleted_per_day"].items()], "day date, deleted bigint")


_QUARTER = "CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-03-31'"

QUERIES = {
    "header_mapped": q_header_mapped,
    "log_policy": q_log_policy,
    "staged_changes": q_staged_changes,
    "merge_partitions": q_merge_partitions,
    "crash_restart": q_crash_restart,
    "ingest_commits": q_ingest_commits,
    "audit_job": q_audit_job,
    "archive_totals": q_archive_totals,
    "archive_validate": q_archive_validate,
    "retention_keep": q_retention_keep,
    "retention_counts": q_retention_counts,
}

ORACLE = {
    "header_mapped": HEADER_MAPPED_SQL,
    "log_policy": LOG_POLICY_SQL,
    "staged_changes": STAGED_CHANGES_SQL,
    "merge_partitions": MERGE_PARTITIONS_SQL,
    "crash_restart": CRASH_RESTART_SQL,
    "ingest_commits": INGEST_COMMITS_SQL,
    "audit_job": AUDIT_JOB_SQL,
    "archive_totals": f"""SELECT count(*) AS rows, count(DISTINCT CAST(o_orderdate AS DATE)) AS partitions, '2000-01-01_a_2000-03-31' AS period
                          FROM orders WHERE {_QUARTER}""",
    "archive_validate": f"""SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS source_rows, count(*) AS archived_rows,
                            CAST(o_orderdate AS DATE) <> DATE '{CHANGED_DAY}' AS valid FROM orders WHERE {_QUARTER} GROUP BY 1""",
    "retention_keep": f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date FROM orders
                          WHERE NOT ({_QUARTER}) OR o_orderdate IS NULL OR CAST(o_orderdate AS DATE) = DATE '{CHANGED_DAY}'""",
    "retention_counts": f"SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS deleted FROM orders WHERE {_QUARTER} GROUP BY 1",
}
