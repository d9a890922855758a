import datetime as dt
import os

from pyspark.sql import functions as F

from tests.fixtures import row, write_hourly
from vitrine.plans.ingest import IngestConfig, IngestJob

RUN = "2024-01-05 08:05:00"  # inside the transition window: hours 08 and 07


def _job(spark, tmp, **kw):
    cfg = IngestConfig(source_root=os.path.join(tmp, "src"), table_path=os.path.join(tmp, "table"),
                       state_path=os.path.join(tmp, "state"), **kw)
    return IngestJob(spark, cfg)


def _table(job):
    cols = ["cap_id", "lite_id", "time", "event_seq", "scan_position", "nominal_length", "total_result"]
    return sorted(tuple(r) for r in job.table.read().select(*cols).collect())


def test_ingest_end_to_end(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 7, [row(time="07:59:59", lite="4090", cap="5", measure="1.#INF"),
                                        row(time="07:59:59", lite="4090", cap="5", measure="2"),
                                        row(time="bad", lite="1", cap="1")])
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", result=" X ")])
    write_hourly(src, "2024-01-05", 6, [row(time="06:00:00", lite="1", cap="1")])  # outside window
    job = _job(spark, tmp)
    out = job.run(RUN, extraction_ts=dt.datetime(2024, 1, 5, 8, 5))
    assert out["status"] == "success" and out["files"] == 2 and out["rows"] == 3
    t = _table(job)
    assert t == [
        (5, 4090, dt.datetime(2024, 1, 5, 7, 59, 59), 0, 11, None, "OK"),
        (5, 4090, dt.datetime(2024, 1, 5, 7, 59, 59), 1, 11, 2.0, "OK"),
        (7, 7, dt.datetime(2024, 1, 5, 8, 0, 1), 0, 0, 1.5, "X"),
    ]
    parts = sorted(os.listdir(os.path.join(tmp, "table")))
    assert "event_date=2024-01-05" in parts
    # the row without a valid time is quarantined, not dropped silently
    assert spark.read.parquet(job.rejected_path).count() == 1

    # nothing changed -> skipped
    assert job.run(RUN)["status"] == "no_changes"

    # file grows -> re-read whole file; replayed rows update, new rows insert
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", measure="9", result="X"),
                                        row(time="08:00:02", lite="8", cap="8")])
    out = job.run(RUN)
    assert out["rows"] == 2
    t = _table(job)
    assert len(t) == 4 and (7, 7, dt.datetime(2024, 1, 5, 8, 0, 1), 0, 0, 9.0, "X") in t
    changes = job.changed_files(RUN).collect()
    assert changes == []

    # file shrinks -> recreated, read again; rows no longer in the file stay (upsert)
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", measure="3")])
    acts = {r["file_key"]: r["action"] for r in job.changed_files(RUN).collect()}
    assert acts == {"watermark_cut2_20240105_08": "recreated"}
    job.run(RUN)
    assert len(_table(job)) == 4

    log = spark.read.parquet(job.run_log_path)
    assert log.where("status = 'success'").count() == 4
    wm = {r["file_key"]: r["size"] for r in job.watermark().collect()}
    assert wm["watermark_cut2_20240105_08"] == os.path.getsize(os.path.join(src, "2024/01/05/08.csv"))


def test_replay_is_idempotent_and_ignore_mode(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7") for _ in range(4)])
    job = _job(spark, tmp)
    job.run(RUN)
    first = _table(job)
    assert [r[3] for r in first] == [0, 1, 2, 3]
    # forget the watermark: the same file is read and merged again
    job2 = _job(spark, tmp)
    job2.watermark_path = os.path.join(tmp, "state", "watermark_reset")
    job2.run(RUN)
    assert _table(job2) == first

    tmp2 = os.path.join(tmp, "ignore")
    src2 = os.path.join(tmp2, "src")
    write_hourly(src2, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", measure="1")])
    j = _job(spark, tmp2, merge_mode="ignore")
    j.run(RUN)
    write_hourly(src2, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", measure="2"),
                                         row(time="08:00:02", lite="7", cap="7", measure="2")])
    j.run(RUN)
    assert [r[5] for r in _table(j)] == [1.0, 2.0]  # existing kept, new inserted


def test_same_key_in_two_files_last_write_wins(spark, tmp):
    src = os.path.join(tmp, "src")
    # both files carry the same (cap, lite, time, seq); previous hour is applied last
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:00", lite="1", cap="1", measure="8")])
    write_hourly(src, "2024-01-05", 7, [row(time="08:00:00", lite="1", cap="1", measure="7")])
    job = _job(spark, tmp)
    job.run(RUN)
    assert [r[5] for r in _table(job)] == [7.0]


def test_bad_file_does_not_block_others(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 8, [row(lite="1")], raw_lines=["08:00:00;1"])
    write_hourly(src, "2024-01-05", 7, [row(time="07:00:00", lite="2")])
    job = _job(spark, tmp)
    out = job.run(RUN)
    assert out["status"] == "error" and len(out["rejected_files"]) == 1
    assert [r[1] for r in _table(job)] == [2]
    # the failed file keeps its old watermark and is tried again next run
    assert [r["file_key"] for r in job.changed_files(RUN).collect()] == ["watermark_cut2_20240105_08"]


def test_recover_replays_interrupted_overwrite(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7")])
    job = _job(spark, tmp)
    job.run(RUN)
    before = _table(job)
    # simulate: a later batch wrote its staging copy and journal entry, then died
    staged = job.table.read().withColumn("nominal_length", F.lit(42.0))
    staging = os.path.join(tmp, "staging_x")
    staged.write.mode("overwrite").partitionBy(*job.cfg.partition_cols).parquet(staging)
    job.journal.record("batch_x", staging, "staged")
    assert job.recover() == ["batch_x"]
    after = _table(job)
    assert len(after) == len(before) and [r[5] for r in after] == [42.0]
    assert job.recover() == []


def test_equal_size_rewrite_needs_mtime(spark, tmp):
    import time
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", measure="1")])
    plain = _job(spark, os.path.join(tmp, "a"))
    plain.cfg.source_root = src
    strict = _job(spark, os.path.join(tmp, "b"), compare_mtime=True)
    strict.cfg.source_root = src
    plain.run(RUN)
    strict.run(RUN)
    time.sleep(1.2)
    # same length, different value: the size watermark alone cannot see it
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="7", cap="7", measure="2")])
    assert plain.run(RUN)["status"] == "no_changes"
    assert strict.run(RUN)["status"] == "success"
    assert [r[5] for r in _table(strict)] == [2.0]
    assert [r[5] for r in _table(plain)] == [1.0]


def test_compact_state_keeps_watermark(spark, tmp):
    import glob
    src = os.path.join(tmp, "src")
    job = _job(spark, tmp)
    for n in range(1, 4):  # the file grows three times: three watermark entries
        write_hourly(src, "2024-01-05", 8, [row(time=f"08:00:0{i}", lite="7", cap="7") for i in range(n)])
        job.run(RUN)
    before = {r["file_key"]: r["size"] for r in job.watermark().collect()}
    files = lambda: len(glob.glob(os.path.join(job.watermark_path, "file_date=*", "*.parquet")))
    assert files() >= 3
    out = job.compact_state("2024-01-06")
    assert out["watermark"] == 3 and files() == 1
    assert {r["file_key"]: r["size"] for r in job.watermark().collect()} == before
    assert job.recover() == []
