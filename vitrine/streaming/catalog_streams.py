"""Streaming forms of catalog queries: the driver's events table replayed as a stream.

The events arrive as ``PARTS`` consecutive pieces in time order. After each piece the query is
started on the same checkpoint and processes what is new, so every result is the product of
several micro-batches and as many restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.calendar import hour_start
from vitrine.operators.sequence import with_event_seq
from vitrine.plans.tables import LakeTable, MergeJournal
from vitrine.session import fresh_dir
from vitrine.sources.fs import delete_path
from vitrine.spec import TRANSITION_WINDOW_MINUTES
from vitrine.streaming.ingest import day_of_instant, run_micro_batches, utc_instant
from vitrine.streaming.late import LateRows, run_with_late_rows

LATE = f"{TRANSITION_WINDOW_MINUTES} minutes"
PARTS = 4
#: The replay with late rows: pieces end at these times; a third of the rows of the last hours
#: before such a time comes one piece later.
CUTS = ("2024-01-08 00:00:00", "2024-01-16 00:00:00", "2024-01-23 00:00:00")
HELD_BACK_HOURS, HELD_BACK_EVERY = 12, 3


def _replay(spark: SparkSession, d: str, run) -> None:
    """Write the events piece by piece; ``run(stream)`` processes the new piece each time."""
    ev = spark.read.parquet(f"{d.rstrip('/')}/events.parquet")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = ev.agg(F.percentile_approx(at, [k / PARTS for k in range(1, PARTS)])).first()[0] or []
    piece = sum([(at > c).cast("int") for c in cuts], F.lit(0))
    src = fresh_dir(spark, "stream_events")
    for k in range(PARTS):
        ev.where(F.coalesce(piece, F.lit(0)) == k).write.mode("append").parquet(src)
        run(spark.readStream.schema(ev.schema).parquet(src).withColumn("event_time", utc_instant("ts")))


def renumber(table: LakeTable, batch: DataFrame, batch_id: int) -> None:
    """Merge a micro-batch of events and number the hours it touches as a whole: rows of an
    hour that came in several batches (or twice) get the numbers of one complete file."""
    keep = ["event_id", "user_id", "event_type", "file_hour", "event_date"]
    rows = batch.select("event_id", "user_id", "event_type", hour_start("ts").alias("file_hour"),
                        F.to_date("ts").alias("event_date"))
    if table.exists():
        days = rows.agg(F.min("event_date"), F.max("event_date")).first()
        hours = rows.select("file_hour").distinct()
        stored = table.read_days(days[0], days[1]).join(hours, "file_hour", "left_semi").select(*keep)
        rows = rows.unionByName(stored).dropDuplicates(["event_id"])
    seq = with_event_seq(rows, ["user_id", "event_type"], ["event_id"], scope_cols=["file_hour"])
    _merge_staged(table, seq, ["event_id"], f"stream_{batch_id}")


def _merge_staged(table: LakeTable, rows: DataFrame, keys, label: str, mode: str = "update") -> None:
    """Merge through a written copy and a journal; an overwrite that an earlier try of the
    stream left half done is finished first. The copy goes afterwards. The batch is evaluated
    once, by writing it: every further action would run its stateful operators (and count the
    rows they drop) again."""
    journal = MergeJournal(table.spark, f"{table.path.rstrip('/')}_journal")
    for batch, staging in journal.pending():
        table.finish(batch, staging, journal)
    staged = fresh_dir(table.spark, "staging", label)
    rows.write.parquet(staged)
    table.merge(table.spark.read.schema(rows.schema).parquet(staged), keys, mode=mode, journal=journal)
    delete_path(table.spark, staged)


def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events -> per micro-batch: event_seq per whole hourly file -> keyed merge."""
    table = LakeTable(spark, fresh_dir(spark, "stream_ingest"))
    ckpt = fresh_dir(spark, "streams", "stream_ingest")

    def handle(batch: DataFrame, batch_id: int):
        if not batch.isEmpty():
            renumber(table, batch, batch_id)

    _replay(spark, d, lambda s: run_micro_batches(s, handle, "stream_ingest", checkpoint=ckpt))
    return table.read().select("event_id", "user_id", "event_type", "event_seq")


def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """One record per (user, type, hour). The stream drops repeats within the watermark delay
    (and rows later than that); the keyed sink ignores records that an earlier batch, or an
    earlier try of the same batch, already stored."""
    table = LakeTable(spark, fresh_dir(spark, "stream_dedup"), ("day",))
    ckpt = fresh_dir(spark, "streams", "stream_dedup")
    keys = ["user_id", "event_type", "hour_key"]

    def handle(batch: DataFrame, batch_id: int):
        _merge_staged(table, batch.withColumn("day", F.substring("hour_key", 1, 10)), keys, f"dedup_{batch_id}", "ignore")

    def run(events: DataFrame):
        s = events.withWatermark("event_time", LATE).withColumn("hour_key", F.date_format("ts", "yyyy-MM-dd HH"))
        run_micro_batches(s.dropDuplicatesWithinWatermark(keys).select(*keys), handle, "stream_dedup", checkpoint=ckpt)

    _replay(spark, d, run)
    return table.read().select(*keys)


def day_counts(events: DataFrame, table: LakeTable, checkpoint: str):
    """Daily tumbling counts in update mode: a micro-batch emits the days it changed, and they
    replace the stored ones. Days that the watermark has passed leave the state, so it holds the
    open days whatever the length of the stream. Returns the ended query."""
    agg = events.withWatermark("event_time", LATE).groupBy(F.window("event_time", "1 day")) \
        .agg(F.count(F.lit(1)).alias("rows")).select(day_of_instant(F.col("window.start")).alias("day"), "rows")

    def handle(batch: DataFrame, batch_id: int):
        _merge_staged(table, batch.withColumn("month", F.trunc("day", "month")), ["day"], f"days_{batch_id}")

    query = (agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
             .foreachBatch(handle).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def stream_day_counts(spark: SparkSession, d: str) -> DataFrame:
    table = LakeTable(spark, fresh_dir(spark, "stream_day_counts"), ("month",))
    ckpt = fresh_dir(spark, "streams", "stream_day_counts")
    _replay(spark, d, lambda events: day_counts(events, table, ckpt))
    return table.read().select("day", "rows")


def _replay_late(spark: SparkSession, d: str, run) -> None:
    """The events piece by piece, some of each piece's last hours only with the next piece."""
    ev = spark.read.parquet(f"{d.rstrip('/')}/events.parquet")
    cuts = [F.lit(c).cast("timestamp_ntz") for c in CUTS]
    own = sum([(F.col("ts") > c).cast("int") for c in cuts], F.lit(0))
    near = [(F.col("ts") <= c) & (F.col("ts") > c - F.expr(f"INTERVAL {HELD_BACK_HOURS} HOURS")) for c in cuts]
    held = (near[0] | near[1] | near[2]) & (F.col("event_id") % HELD_BACK_EVERY == 0)
    piece = F.coalesce(own + held.cast("int"), F.lit(0))
    src = fresh_dir(spark, "stream_events")
    for k in range(len(CUTS) + 1):
        ev.where(piece == k).write.mode("append").parquet(src)
        run(spark.readStream.schema(ev.schema).parquet(src).withColumn("event_time", utc_instant("ts")))


def _late_run(spark: SparkSession, d: str) -> tuple[LakeTable, LateRows]:
    keys = ["user_id", "event_type", "hour_key"]
    table = LakeTable(spark, fresh_dir(spark, "stream_late"), ("day",))
    late = LateRows(spark, fresh_dir(spark, "stream_late_rows"), TRANSITION_WINDOW_MINUTES)
    ckpt = fresh_dir(spark, "streams", "stream_late")

    def sink(batch: DataFrame, batch_id: int):
        _merge_staged(table, batch.withColumn("day", F.substring("hour_key", 1, 10)), keys, f"late_{batch_id}", "ignore")

    def unique(events: DataFrame) -> DataFrame:
        return events.withColumn("hour_key", F.date_format("ts", "yyyy-MM-dd HH")).dropDuplicatesWithinWatermark(keys).select(*keys)

    _replay_late(spark, d, lambda events: run_with_late_rows(events, unique, sink, late, ckpt, "stream_late"))
    return table, late


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows that the deduplicating stream dropped as later than the bound, by how much."""
    return _late_run(spark, d)[1].rows().select("event_id", "user_id", "event_type", "late_by_us")


def stream_late_kept(spark: SparkSession, d: str) -> DataFrame:
    """What the same stream kept: records of rows on time, or late within the bound."""
    return _late_run(spark, d)[0].read().select("user_id", "event_type", "hour_key")
