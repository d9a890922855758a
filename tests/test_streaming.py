import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tests.fixtures import row, write_hourly
from vitrine.plans.ingest import IngestConfig, IngestJob
from vitrine.plans.tables import LakeTable
from vitrine.streaming.catalog_streams import day_counts
from vitrine.streaming.ingest import run_ingest_stream, utc_instant
from vitrine.streaming.late import LateCountDiffers, LateRows, run_with_late_rows


def _wait(pred, timeout=90):
    end = time.time() + timeout
    while time.time() < end:
        try:
            if pred():
                return True
        except Exception:  # noqa: BLE001 - table folder exists before its first commit
            pass
        time.sleep(0.5)
    return False


def test_growing_file_is_reread_by_the_tick_stream(spark, tmp):
    src = os.path.join(tmp, "src")
    write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="1", cap="1")])
    job = IngestJob(spark, IngestConfig(src, os.path.join(tmp, "table"), os.path.join(tmp, "state")))
    q = run_ingest_stream(job, every="1 second", clock=lambda: "2024-01-05 08:30:00",
                          checkpoint=os.path.join(tmp, "ckpt"))
    try:
        assert _wait(lambda: job.table.exists() and job.table.read().count() == 1)
        # the machine appends to the same hourly file
        write_hourly(src, "2024-01-05", 8, [row(time="08:00:01", lite="1", cap="1"),
                                            row(time="08:00:02", lite="2", cap="1")])
        assert _wait(lambda: job.table.read().count() == 2)
        # the run log is written after the table: wait for it before stopping the stream
        assert _wait(lambda: spark.read.parquet(job.run_log_path).where("status = 'success'").count() == 2)
        assert q.isActive and q.exception() is None
    finally:
        q.stop()
    runs = spark.read.parquet(job.run_log_path)
    assert runs.where("status = 'success'").count() == 2  # unchanged ticks load nothing


def test_stream_restart_from_checkpoint_is_exactly_once(spark, tmp):
    import shutil

    from vitrine.plans.tables import LakeTable
    from vitrine.streaming.catalog_streams import _merge_staged
    from vitrine.streaming.ingest import run_micro_batches
    src = os.path.join(tmp, "in")
    os.makedirs(src)
    shutil.copy("/root/testdata/sf0.001/events.parquet", os.path.join(src, "a.parquet"))
    schema = spark.read.parquet(src).schema
    table, ckpt, batches = LakeTable(spark, os.path.join(tmp, "out"), ("event_type",)), os.path.join(tmp, "ckpt"), []

    def handle(batch, batch_id):
        batches.append(batch_id)
        _merge_staged(table, batch, ["event_id"], "restart")

    def start():
        s = spark.readStream.schema(schema).parquet(src).select("event_id", "user_id", "event_type")
        run_micro_batches(s, handle, "restart", checkpoint=ckpt)

    start()
    assert table.read().count() == 1000
    start()  # restart: the checkpoint says everything was processed
    assert batches == [0]
    shutil.copy("/root/testdata/sf0.001/events.parquet", os.path.join(src, "b.parquet"))
    start()  # a replayed file with the same keys updates, never duplicates
    assert batches == [0, 1] and table.read().count() == 1000


def _pieces(spark, tmp, pieces):
    """Streams over folders of one file per piece, one after the other."""
    src = os.path.join(tmp, "src")
    for k, rows in enumerate(pieces):
        spark.createDataFrame([(i, dt.datetime.fromisoformat(t)) for i, t in rows], "id int, ts timestamp_ntz").coalesce(1) \
            .write.mode("append").parquet(src)
        yield spark.readStream.schema("id int, ts timestamp_ntz").parquet(src).withColumn("event_time", utc_instant("ts"))


LATE = [[(1, "2024-01-05 10:00:00"), (2, "2024-01-05 11:00:00")],
        [(3, "2024-01-05 10:55:00"), (4, "2024-01-05 10:35:00"), (5, "2024-01-05 11:30:00")],  # 5 and 25 minutes late
        [(6, "2024-01-05 11:20:00"), (7, "2024-01-05 11:19:59.999"), (8, "2024-01-05 11:20:00.001"), (9, "2024-01-05 11:20:00.000001")]]


def test_rows_past_the_bound_go_to_the_side_table(spark, tmp):
    kept, found = [], []
    late = LateRows(spark, os.path.join(tmp, "late"), 10)
    for s in _pieces(spark, tmp, LATE):
        found.append(run_with_late_rows(s, lambda x: x.dropDuplicatesWithinWatermark(["id"]),
                                        lambda b, i: kept.extend(r["id"] for r in b.collect()), late, os.path.join(tmp, "ckpt"), "late_test"))
    assert found == [0, 1, 2]  # equal to what the engine dropped, else it raises
    assert sorted(r["id"] for r in late.rows().collect()) == [4, 6, 7]
    assert sorted(kept) == [1, 2, 3, 5, 8, 9]
    assert {r["id"]: r["late_by_us"] for r in late.rows().collect()} == {4: 15 * 60_000_000, 6: 0, 7: 1000}


def test_a_replayed_batch_gives_the_same_side_rows(spark, tmp):
    late = LateRows(spark, os.path.join(tmp, "late"), 10)
    batches = [spark.createDataFrame([(i, dt.datetime.fromisoformat(t)) for i, t in rows], "id int, ts timestamp_ntz")
               .withColumn("event_time", utc_instant("ts")) for rows in LATE]
    for k in (0, 1, 1, 0, 1, 2, 2):
        late.write(batches[k], k)
    assert sorted(r["id"] for r in late.rows().collect()) == [4, 6, 7]
    on_time, after = late.split(batches[1].limit(0), 1)
    assert on_time.count() == after.count() == 0


def test_another_number_than_the_engine_dropped_is_an_error(spark, tmp):
    late = LateRows(spark, os.path.join(tmp, "late"), 10)
    late.write = lambda batch, batch_id: batch.withColumn("late_by_us", F.lit(0)).write.mode("overwrite").parquet(f"{late.path}/rows/batch={batch_id}")
    with pytest.raises(LateCountDiffers):
        for s in _pieces(spark, tmp, LATE[:1]):
            run_with_late_rows(s, lambda x: x.dropDuplicatesWithinWatermark(["id"]), lambda b, i: b.collect(), late, os.path.join(tmp, "ckpt"), "late_error")


def test_day_counts_keep_only_open_days_in_the_state(spark, tmp):
    table, state = LakeTable(spark, os.path.join(tmp, "days"), ("month",)), []
    pieces = [[(k, f"2024-01-{d:02d} {h:02d}:00:00") for k, h in enumerate((1, 9, 17))] for d in range(1, 21)]
    pieces = [sum(pieces[k:k + 4], []) for k in range(0, 20, 4)]
    for s in _pieces(spark, tmp, pieces):
        q = day_counts(s, table, os.path.join(tmp, "ckpt"))
        state.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress][-1])
    assert {(str(r["day"]), r["rows"]) for r in table.read().collect()} == {(f"2024-01-{d:02d}", 3) for d in range(1, 21)}
    assert max(state) <= 1
