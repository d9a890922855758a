import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.fixtures import row, write_hourly, write_plate
from vitrine.plans.archive import archive_quarter
from vitrine.plans.audit import AuditFailed, AuditJob, AuditLine
from vitrine.plans.ingest import IngestConfig, IngestJob
from vitrine.plans.tables import LakeTable
from vitrine.spec import LINES

D = "2024-03-10"


def _plate_table(spark, path, rows):
    df = spark.createDataFrame(rows, "grpid bigint, date timestamp_ntz") \
        .withColumn("event_date", F.to_date("date"))
    df.write.mode("overwrite").partitionBy("event_date").parquet(path)
    return LakeTable(spark, path)


def test_plate_audit_statuses(spark, tmp):
    logs = os.path.join(tmp, "logs")
    t = dt.datetime(2024, 3, 10, 12, 0, 0)
    # day D file (+ a row of D-1 that must be ignored), and the D+1 file holding a late D row
    write_plate(logs, D, [("2024/03/10 12:00:00.500", "1.0"), ("2024/03/10 12:00:01", "2"),
                          ("2024/03/10 12:00:02", "3"), ("2024/03/09 23:59:59", "99"),
                          ("", "5"), ("bad date", "6")])
    write_plate(logs, "2024-03-11", [("2024/03/10 23:59:59", "4"), ("2024/03/11 00:00:01", "77")])
    line = LINES["MIRROR1"]

    # table equal to the log -> ok
    tbl = _plate_table(spark, os.path.join(tmp, "t_ok"), [(i, t) for i in (1, 2, 3, 4)])
    job = AuditJob(spark, [AuditLine(line, logs, tbl)], os.path.join(tmp, "audit"))
    s = job.run(D)
    assert [(r["line"], r["status"]) for r in s.collect()] == [("MIRROR1", "ok")]

    # k = 2 rows missing -> missing_in_db listing exactly those IDs
    tbl = _plate_table(spark, os.path.join(tmp, "t_miss"), [(1, t), (3, t)])
    job = AuditJob(spark, [AuditLine(line, logs, tbl)], os.path.join(tmp, "audit"))
    with pytest.raises(AuditFailed):
        job.run(D)
    r = job.results.read().where("line = 'MIRROR1'").first()
    assert (r["status"], r["total_log"], r["total_db"], r["divergence"], r["ids_missing"]) == \
        ("missing_in_db", 4, 2, 2, "2,4")
    assert r["note"] == "Divergence of 2 record(s). 2 IDs in log missing from DB. GrpID sample: ['2', '4']"

    # extra rows (and a NULL id row, counted but not an ID) -> excess_in_db
    tbl = _plate_table(spark, os.path.join(tmp, "t_extra"),
                       [(i, t) for i in (1, 2, 3, 4, 5)] + [(None, t)])
    job = AuditJob(spark, [AuditLine(line, logs, tbl)], os.path.join(tmp, "audit"))
    with pytest.raises(AuditFailed):
        job.run(D)
    r = job.results.read().first()
    assert (r["status"], r["total_db"], r["divergence"]) == ("excess_in_db", 6, -2)
    assert r["note"].startswith("DB has 2 extra record(s). 1 IDs in DB absent from log.")
    assert job.results.read().count() == 1  # re-run replaced the stored row

    # equal counts, different IDs -> missing_in_db
    tbl = _plate_table(spark, os.path.join(tmp, "t_swap"), [(i, t) for i in (1, 2, 3, 8)])
    job = AuditJob(spark, [AuditLine(line, logs, tbl)], os.path.join(tmp, "audit"))
    with pytest.raises(AuditFailed):
        job.run(D)
    assert job.results.read().first()["status"] == "missing_in_db"


def test_no_log_and_no_result(spark, tmp):
    tbl = _plate_table(spark, os.path.join(tmp, "t"), [(1, dt.datetime(2024, 3, 10, 1))])
    job = AuditJob(spark, [AuditLine(LINES["CUT1"], os.path.join(tmp, "none"), tbl)],
                   os.path.join(tmp, "audit"))
    s = job.run(D, fail_on_divergence=False).collect()
    assert [(r["status"]) for r in s] == ["no_log"]
    r = job.results.read().first()
    assert (r["total_log"], r["total_db"], r["note"]) == (0, 0, "No log files found for this audit date.")


def test_hourly_audit_against_ingested_table(spark, tmp):
    src = os.path.join(tmp, "src")
    rows07 = [row(time="07:00:00", lite="1", cap="2") for _ in range(3)]
    write_hourly(src, D, 7, rows07)
    write_hourly(src, D, 23, [row(time="23:59:59", lite="3", cap="2")])
    # next day's 00 file: its rows are stamped D+1 and contribute nothing to D
    write_hourly(src, "2024-03-11", 0, [row(time="00:00:05", lite="4", cap="2")])
    ing = IngestJob(spark, IngestConfig(src, os.path.join(tmp, "table"), os.path.join(tmp, "state")))
    ing.run(start=D, end="2024-03-11")
    job = AuditJob(spark, [AuditLine(LINES["CUT2"], src, ing.table)], os.path.join(tmp, "audit"))
    s = job.run(D)
    assert [r["status"] for r in s.collect()] == ["ok"]
    r = job.results.read().first()
    assert (r["total_log"], r["total_db"]) == (4, 4)
    # remove one stored row -> missing_in_db naming its composite key
    kept = ing.table.read().where("event_seq <> 2")
    kept.write.mode("overwrite").partitionBy("event_date", "event_hour").parquet(os.path.join(tmp, "t2"))
    job2 = AuditJob(spark, [AuditLine(LINES["CUT2"], src, LakeTable(spark, os.path.join(tmp, "t2"),
                                                                     ("event_date", "event_hour")))],
                    os.path.join(tmp, "audit2"))
    with pytest.raises(AuditFailed):
        job2.run(D)
    r = job2.results.read().first()
    assert (r["status"], r["ids_missing"]) == ("missing_in_db", "2|1|07:00:00|2")
    assert "CompositeKey(Cap|Lite|Time|Seq) sample: ['2|1|07:00:00|2']" in r["note"]


def test_archive_quarter(spark, tmp):
    days = [dt.date(2024, 12, 30), dt.date(2025, 1, 1), dt.date(2025, 2, 14), dt.date(2025, 3, 31),
            dt.date(2025, 4, 1)]
    rows = [(i, dt.datetime.combine(d, dt.time(1))) for i, d in enumerate(days * 3)]
    tbl = _plate_table(spark, os.path.join(tmp, "src"), rows)
    with pytest.raises(ValueError):
        archive_quarter(spark, tbl, "t", os.path.join(tmp, "arch"), "2025-04-16")
    m = archive_quarter(spark, tbl, "t", os.path.join(tmp, "arch"), "2025-04-15")
    assert m["period"] == "2025-01-01_a_2025-03-31"
    assert (m["rows"], m["partitions"], m["deleted_total"]) == (9, 3, 9)
    assert m["deleted_per_day"] == {"2025-01-01": 3, "2025-02-14": 3, "2025-03-31": 3}
    arch = spark.read.parquet(m["path"])
    kept = tbl.read()
    assert arch.count() + kept.count() == len(rows)
    assert sorted({r["event_date"] for r in kept.collect()}) == [dt.date(2024, 12, 30), dt.date(2025, 4, 1)]
    # a second run finds nothing left to archive and deletes nothing
    m2 = archive_quarter(spark, tbl, "t", os.path.join(tmp, "arch"), "2025-04-15")
    assert m2["deleted_total"] == 0


def test_plate_log_is_read_lossily(spark, tmp):
    logs = os.path.join(tmp, "logs")
    path = write_plate(logs, D, [("2024/03/10 12:00:00", "1")])
    with open(path, "ab") as f:
        f.write(b"2024/03/10 12:00:01\t2\tbad\xff byte\n")
    t = dt.datetime(2024, 3, 10, 12)
    tbl = _plate_table(spark, os.path.join(tmp, "t"), [(1, t), (2, t)])
    job = AuditJob(spark, [AuditLine(LINES["MIRROR1"], logs, tbl)], os.path.join(tmp, "audit"))
    assert [r["status"] for r in job.run(D).collect()] == ["ok"]
