"""Cases in which an audit must not report ok."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.fixtures import row, write_hourly, write_plate
from vitrine.functions.clean import log_time
from vitrine.operators import reconcile as rc
from vitrine.plans.audit import AuditJob, AuditLine
from vitrine.plans.tables import LakeTable, MergeJournal
from vitrine.sources.logscan import read_log
from vitrine.spec import LINES

D, E = "2024-01-05", "2024-01-06"


def plate_table(spark, path, rows, kind="bigint"):
    spark.createDataFrame([(None if i is None else i, t) for i, t in rows], f"grpid {kind}, date timestamp_ntz") \
        .withColumn("event_date", F.to_date("date")).write.partitionBy("event_date").parquet(path)
    return LakeTable(spark, path)


def test_one_run_over_a_range(spark, tmp):
    t = dt.datetime(2024, 1, 5, 10)
    # MIRROR1: IDs that are no 64-bit integers stay IDs; a DOUBLE table key meets its log ID;
    # a date in another format is not this line's
    m = os.path.join(tmp, "m")
    write_plate(m, D, [("2024/01/05 10:00:00", k) for k in ("A77", "99999999999999999999", "123.0", "007", "5")]
                + [("2024-01-05 10:00:03", "4")])
    write_plate(m, E, [("2024/01/06 10:00:00", "1")])
    mt = plate_table(spark, os.path.join(tmp, "mt"), [(123.0, t), (7.0, t), (5.0, t), (1.0, t + dt.timedelta(1))], "double")
    # CUT1: the file of day E has a header without the ID column
    c = os.path.join(tmp, "c")
    write_plate(c, D, [("2024/01/05 10:00:00", "1")])
    os.makedirs(os.path.join(c, "2024-01"), exist_ok=True)
    with open(os.path.join(c, "2024-01", f"{E}-PlateLog.txt"), "w") as f:
        f.write("Date\tOther\n2024/01/06 10:00:00\t1\n")
    ct = plate_table(spark, os.path.join(tmp, "ct"), [(1, t)])
    # CUT2: only an hour of day E that is not 00, so day D has no log
    h = os.path.join(tmp, "h")
    write_hourly(h, E, 5, [row(time="05:00:00", lite="1", cap="2")])
    job = AuditJob(spark, [AuditLine(LINES["MIRROR1"], m, mt), AuditLine(LINES["CUT1"], c, ct),
                           AuditLine(LINES["CUT2"], h, LakeTable(spark, os.path.join(tmp, "none")))], os.path.join(tmp, "audit"))
    got = {(r["line"], str(r["audited_date"])): r["status"] for r in job.run(D, E, fail_on_divergence=False).collect()}
    stored = {(r["line"], str(r["audited_date"])): r for r in job.results.read().collect()}
    r = stored["MIRROR1", D]
    assert (r["total_log"], r["total_db"], r["status"], r["ids_missing"]) == (5, 3, "missing_in_db", "99999999999999999999,A77")
    assert got["MIRROR1", E] == "ok"
    assert got["CUT1", D] == got["CUT1", E] == "error"  # the rejected file may hold late rows of D
    assert "Missing columns" in stored["CUT1", E]["note"] and stored["CUT1", E]["total_log"] == 0
    assert got["CUT2", D] == "no_log" and got["CUT2", E] == "missing_in_db"


def test_a_failing_line_leaves_the_others(spark, tmp):
    m = os.path.join(tmp, "m")
    write_plate(m, D, [("2024/01/05 10:00:00", "1")])
    good = plate_table(spark, os.path.join(tmp, "t"), [(1, dt.datetime(2024, 1, 5, 10))])
    broken = os.path.join(tmp, "broken")
    spark.range(3).withColumn("event_date", F.lit(D).cast("date")).write.partitionBy("event_date").parquet(broken)  # no such columns
    job = AuditJob(spark, [AuditLine(LINES["CUT1"], m, LakeTable(spark, broken)), AuditLine(LINES["MIRROR1"], m, good)], os.path.join(tmp, "a"))
    got = {r["line"]: r["status"] for r in job.run(D, fail_on_divergence=False).collect()}
    assert got == {"CUT1": "error", "MIRROR1": "ok"}
    note = job.results.read().where("line = 'CUT1'").first()["note"]
    assert note.startswith("Audit error: ")


@pytest.mark.parametrize("mode,strict", [("flag", True), ("flag", False), ("quarantine", False), ("fail_file", False)])
def test_ragged_rows_are_flagged_whatever_is_selected(spark, tmp, mode, strict):
    os.makedirs(os.path.join(tmp, "2024-01"))
    p = os.path.join(tmp, "2024-01", f"{D}-PlateLog.txt")
    with open(p, "w") as f:
        f.write("Date\tX\tGrpID\n2024/01/05 10:00:00\tx\t1\n2024/01/05 10:00:01\tx\t2\tlong\n2024/01/05 10:00:02\tx\n2024/01/05 10:00:03\tx\t4\n")
    read = read_log(spark, [p], "\t", ("grpid",), kind="plate", on_corrupt=mode, strict_utf8=strict)
    assert read.corrupt.count() == 2
    if mode == "flag":
        assert read.rows.where("_corrupt").count() == 2
    else:
        assert sorted(r["grpid"] for r in read.rows.select("grpid").collect()) == (["1", "4"] if mode == "quarantine" else [])


def test_malformed_rows_are_counted(spark, tmp):
    m = os.path.join(tmp, "m", "2024-01")
    os.makedirs(m)
    with open(os.path.join(m, f"{D}-PlateLog.txt"), "w") as f:
        f.write("Date\tGrpID\n2024/01/05 10:00:00\t1\n2024/01/05 10:00:01\t2\tlong\n")
    tbl = plate_table(spark, os.path.join(tmp, "t"), [(1, dt.datetime(2024, 1, 5, 10))])
    job = AuditJob(spark, [AuditLine(LINES["MIRROR1"], os.path.join(tmp, "m"), tbl)], os.path.join(tmp, "a"))
    assert [r["status"] for r in job.run(D).collect()] == ["ok"]
    assert job.results.read().first()["malformed"] == 1


def test_open_batches_are_found_at_any_age(spark, tmp):
    j = MergeJournal(spark, os.path.join(tmp, "j"))
    old = dt.datetime(2020, 1, 1)
    spark.createDataFrame([("old", "s1", "staged", old, old.date()), ("done", "s2", "staged", old, old.date()),
                           ("done", "s2", "committed", old, old.date())],
                          "batch_id string, staging string, state string, at timestamp_ntz, day date").write.partitionBy("day").parquet(j.path)
    assert j.pending() == [("old", "s1")]


def test_merge_into_many_partitions(spark, tmp):
    """A wide re-load neither builds a predicate per partition nor loses rows."""
    n = 400
    days = [(i, dt.date(2020, 1, 1) + dt.timedelta(i), i) for i in range(n)]
    table = LakeTable(spark, os.path.join(tmp, "t"))
    base = spark.createDataFrame(days, "k int, event_date date, v int").repartition(2)
    table.merge(base, ["k", "event_date"])
    again = spark.createDataFrame([(i, d, -1) for i, d, _ in days if i % 2] + [(1000, days[0][1], 7)], "k int, event_date date, v int")
    assert table.merge(again, ["k", "event_date"])["partitions"] == n // 2 + 1
    got = {(r["k"], r["v"]) for r in table.read().collect()}
    assert got == {(i, -1 if i % 2 else i) for i in range(n)} | {(1000, 7)}


def test_ranks_are_split_before_one_task_sorts_a_day(spark):
    keys = spark.range(20000).select(F.lit("L").alias("line"), F.lit(D).cast("date").alias("audited_date"), F.col("id").cast("string").alias("key"))
    top = rc.ranked_keys(keys, rc.IDS_TEXT_RANKS).first()["keys"]
    assert top == sorted(str(i) for i in range(20000))[:rc.IDS_TEXT_RANKS]
    few = rc.first_ranks(keys, rc.DAY, 10)._jdf.queryExecution().optimizedPlan().toString()
    assert few.count("Window [") == 2 and "_s" in few


def test_log_time_takes_one_format(spark):
    df = spark.createDataFrame([("2024/01/05 10:00:03.5",), ("2024-01-05 10:00:03",)], "t string")
    assert [r[0] is None for r in df.select(log_time("t")).collect()] == [False, True]
    assert [r[0] is None for r in df.select(log_time("t", date_sep="-")).collect()] == [True, False]


def test_every_registered_table_is_archived_by_its_own_time_column(spark, tmp):
    from vitrine.plans.archive import archive_registry, with_event_date
    from vitrine.spec import ARCHIVE_TABLES
    for name, col in ARCHIVE_TABLES.items():
        rows = spark.createDataFrame([(k, dt.datetime(2024, 3, 30 + k % 2, 5) if k < 6 else dt.datetime(2024, 4, 2)) for k in range(8)],
                                     f"id int, `{col}` timestamp_ntz")
        with_event_date(rows, name).write.partitionBy("event_date").parquet(os.path.join(tmp, "t", name))
    got = archive_registry(spark, os.path.join(tmp, "t"), os.path.join(tmp, "a"), "2024-04-10")
    assert set(got) == set(ARCHIVE_TABLES)
    for name, r in got.items():
        assert r["rows"] == r["deleted_total"] == 6 and r["partitions"] == 2 and not r["invalid_days"]
        assert LakeTable(spark, os.path.join(tmp, "t", name)).read().count() == 2


def test_a_day_whose_copy_differs_stays(spark):
    from vitrine.operators.archive import validate_counts
    src = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 2))], "id int, event_date date")
    bad = src.where("id <> 2")
    assert {str(r["day"]): r["valid"] for r in validate_counts(src, bad).collect()} == {"2024-01-01": False, "2024-01-02": True}


def test_archive_failure_is_raised_after_the_other_tables(spark, tmp):
    import pytest

    from vitrine.plans.archive import ArchiveFailed, archive_registry, with_event_date
    from vitrine.spec import ARCHIVE_TABLES
    names = list(ARCHIVE_TABLES)[:2]
    for name in names:
        rows = spark.createDataFrame([(k, dt.datetime(2024, 3, 30 + k % 2, 5)) for k in range(4)], f"id int, `{ARCHIVE_TABLES[name]}` timestamp_ntz")
        with_event_date(rows, name).write.partitionBy("event_date").parquet(os.path.join(tmp, "t", name))
    blocked = os.path.join(tmp, "a")
    os.makedirs(blocked)
    open(os.path.join(blocked, names[0]), "w").close()  # a file where the first table's folder should go
    with pytest.raises(ArchiveFailed) as failed:
        archive_registry(spark, os.path.join(tmp, "t"), blocked, "2024-04-10")
    assert set(failed.value.errors) == {names[0]} and failed.value.results[names[1]]["deleted_total"] == 4
    assert LakeTable(spark, os.path.join(tmp, "t", names[0])).read().count() == 4
    with pytest.raises(ArchiveFailed):  # an open quarter is refused for every table
        archive_registry(spark, os.path.join(tmp, "t"), os.path.join(tmp, "b"), "2024-04-20")
