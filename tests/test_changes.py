import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import row, write_hourly
from vitrine.operators.merge import change_set, changes_per_file
from vitrine.plans.ingest import IngestConfig, IngestJob
from vitrine.plans.tables import LakeTable, MergeJournal

RUN = "2024-01-05 08:05:00"


def _job(spark, tmp, **kw):
    return IngestJob(spark, IngestConfig(os.path.join(tmp, "src"), os.path.join(tmp, "table"), os.path.join(tmp, "state"), **kw))


def _state(job):
    cols = ["cap_id", "lite_id", "time", "event_seq", "nominal_length", "total_result"]
    marks = sorted((r["file_key"], r["size"]) for r in job.watermark().collect())
    return sorted(tuple(r) for r in job.table.read().select(*cols).collect()), marks


@pytest.mark.parametrize("mode", ["update", "ignore"])
def test_changes_equal_applying_the_files_one_by_one(spark, mode):
    rng = random.Random(3)
    stored = {k: rng.choice([1, 2, None]) for k in [None, *range(12)]}
    staged = [(k, rng.choice([1, 2, None]), f) for f in range(4) for k in [None, *range(0, 24, f + 1)]]
    table, want = dict(stored), {}
    for k, v, f in staged:
        what = "inserted" if k not in table else "ignored" if mode == "ignore" else "unchanged" if table[k] == v else "updated"
        want.setdefault(f"f{f}", []).append(what)
        if what in ("inserted", "updated"):
            table[k] = v
    existing = spark.createDataFrame(list(stored.items()), "k int, v int").withColumn("loaded", F.lit(1))
    rows = spark.createDataFrame([(k, v, f"f{f}", f) for k, v, f in staged], "k int, v int, file_key string, load_order int").withColumn("loaded", F.lit(2))
    got = changes_per_file(change_set(existing, rows, ["k"], ["load_order"], ignore=("loaded",), mode=mode)).collect()
    kinds = ("inserted", "updated", "unchanged", "ignored")
    assert {r["file_key"]: [r[c] for c in kinds] for r in got} == {f: [x.count(c) for c in kinds] for f, x in want.items()}
    assert all(r["staged"] == len(want[r["file_key"]]) and r["rows"] == r["staged"] - r["ignored"] for r in got)


def test_two_files_with_the_same_keys_both_report_all_their_rows(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite=str(k), cap="1", measure="8") for k in range(5)])
    write_hourly(src, "2024-01-05", 7, [row(time="08:00:00", lite=str(k), cap="1", measure="7") for k in range(3, 9)])
    job = _job(spark, tmp)
    out = job.run(RUN)
    files = {"08": "watermark_cut2_20240105_08", "07": "watermark_cut2_20240105_07"}
    assert out["rows_per_file"] == {files["08"]: 5, files["07"]: 6} and out["rows"] == 11
    kinds = lambda f: tuple(out["changes"][files[f]][k] for k in ("staged", "inserted", "updated", "unchanged"))
    assert kinds("08") == (5, 5, 0, 0) and kinds("07") == (6, 4, 2, 0)  # the previous hour is applied over the current one
    logged = {r["file_name"]: r["total_registros"] for r in spark.read.parquet(job.run_log_path).collect()}
    assert logged == out["rows_per_file"] and job.table.read().count() == 9
    write_hourly(src, "2024-01-05", 7, [row(time="08:00:00", lite=str(k), cap="1", measure="7") for k in range(3, 10)])
    out = job.run(RUN)
    assert kinds("07") == (7, 1, 0, 6)  # the load time alone is no update


@pytest.mark.parametrize("point", ["staged", "overwritten", "logged", "watermarked"])
def test_a_run_that_dies_anywhere_ends_in_the_same_table(spark, tmp, point):
    calm, hit = _job(spark, os.path.join(tmp, "calm")), _job(spark, os.path.join(tmp, "hit"))
    for job in (calm, hit):
        src = job.cfg.source_root
        write_hourly(src, "2024-01-05", 7, [row(time="07:00:00", lite=str(k)) for k in range(3)])
        write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite=str(k)) for k in range(3)])
        job.run(RUN)
        write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite=str(k), measure="9") for k in range(1, 6)])
    calm.run(RUN)

    def die(name):
        if name == point:
            raise KeyboardInterrupt(name)

    hit.at = die
    with pytest.raises(KeyboardInterrupt):
        hit.run(RUN)
    again = _job(spark, os.path.join(tmp, "hit"))
    again.run(RUN)
    assert _state(again) == _state(calm)
    assert again.journal.pending() == [] and again.run(RUN)["status"] == "no_changes"
    left = [p for p in os.listdir(os.path.dirname(_staging(spark))) if again_batch(hit, p)]
    assert left == []


def _staging(spark):
    from vitrine.session import shared_dir
    return shared_dir(spark, "staging", "x").replace("file://", "").replace("file:", "")


def again_batch(job, name):
    batches = {r["batch_id"] for r in job.spark.read.parquet(job.journal.path).collect()}
    return name.split("_")[0] in batches


def test_failed_file_keeps_its_old_size_and_later_succeeds(spark, tmp):
    job = _job(spark, tmp)
    src = job.cfg.source_root
    path = write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite="1")])
    job.run(RUN)
    size = os.path.getsize(path)
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite="1"), row(time="08:00:01", lite="2")], raw_lines=["half;a;row"])
    assert job.run(RUN)["status"] == "error"
    assert [r["size"] for r in job.watermark().collect()] == [size] and job.table.read().count() == 1
    path = write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite="1"), row(time="08:00:01", lite="2"), row(time="08:00:02", lite="3")])
    assert job.run(RUN)["status"] == "success"
    assert [r["size"] for r in job.watermark().collect()] == [os.path.getsize(path)] and job.table.read().count() == 3


@pytest.mark.parametrize("point", ["staged", "overwritten"])
def test_a_half_done_merge_is_finished_from_the_journal(spark, tmp, point):
    table, journal = LakeTable(spark, os.path.join(tmp, "t")), MergeJournal(spark, os.path.join(tmp, "j"))
    day = lambda k: dt.date(2024, 1, 1 + k % 3)
    table.merge(spark.createDataFrame([(k, day(k), 0) for k in range(9)], "k int, event_date date, v int"), ["k"], journal=journal)

    def die(name):
        if name == point:
            raise KeyboardInterrupt(name)

    with pytest.raises(KeyboardInterrupt):
        table.merge(spark.createDataFrame([(k, day(k), 1) for k in range(6, 12)], "k int, event_date date, v int"), ["k"], journal=journal, at=die)
    for batch, staging in journal.pending():
        table.finish(batch, staging, journal)
    assert {(r["k"], r["v"]) for r in table.read().collect()} == {(k, int(k > 5)) for k in range(12)}
    assert journal.pending() == []


def test_a_day_range_lists_only_its_folders(spark, tmp):
    table = LakeTable(spark, os.path.join(tmp, "t"))
    first = dt.date(2020, 1, 1)
    rows = spark.range(600).select(F.col("id").cast("int").alias("k"), F.when(F.col("id") < 590, F.expr("date_add(date'2020-01-01', cast(id % 300 as int))")).alias("event_date"))
    rows.repartition(4, "event_date").write.partitionBy("event_date").parquet(table.path)
    got = table.read_days("2020-02-01", "2020-02-03")
    assert sorted({f.split("event_date=")[1][:10] for f in got.inputFiles()}) == ["2020-02-01", "2020-02-02", "2020-02-03"]
    assert sorted(r["k"] for r in got.collect()) == [31, 32, 33, 331, 332, 333]
    assert table.read_days("2019-01-01", "2019-12-31").count() == 0
    batch = spark.createDataFrame([(31, first + dt.timedelta(31)), (595, None), (9, dt.date(2025, 1, 1))], "k int, event_date date")
    near = table.touched(batch.where("event_date < '2024-01-01' or event_date is null"), first + dt.timedelta(31), first + dt.timedelta(31))
    assert sorted(r["k"] for r in near.collect()) == [31, 331, *range(590, 600)]
    assert len({f.split("event_date=")[1].split("/")[0] for f in near.inputFiles()}) == 2
    table.merge(batch, ["k", "event_date"])
    assert table.read().count() == 601 and table.read().where("event_date is null").count() == 10
