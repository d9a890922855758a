"""Micro-batch ingest with Structured Streaming.

* ``utc_instant``: watermarks need TIMESTAMP; log times are zone-less. The wall clock
  is mapped to the instant with the same UTC reading using date/time arithmetic
  only, so the result does not depend on the session time zone.
* ``run_micro_batches``: source -> transformation -> ``foreachBatch`` sink, with the
  checkpoint in the shared folder. Each batch runs the same batch operators (clean,
  sequence, upsert), so a replayed batch writes the same rows again (idempotent).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.session import fresh_dir

__all__ = ["utc_instant", "day_of_instant", "run_micro_batches", "run_ingest_stream"]


def utc_instant(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    secs = (F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long") * 86400
            + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    return F.timestamp_micros(secs * 1_000_000 + _fraction_micros(c))


def _fraction_micros(c: Column) -> Column:
    # microseconds inside the second, read from the text form (zone-free for NTZ)
    frac = F.regexp_extract(F.date_format(c, "SSSSSS"), r"([0-9]{6})", 1)
    return F.coalesce(frac.try_cast("long"), F.lit(0))


def day_of_instant(col) -> Column:
    """Calendar day of an instant read in UTC, without the session time zone."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_from_unix_date(F.floor(F.unix_seconds(c) / 86400).cast("int"))


def run_micro_batches(stream: DataFrame, handle_batch, name: str, available_now: bool = True,
                      processing_time: str = "2 minutes", checkpoint: str | None = None):
    """Start ``stream.writeStream.foreachBatch(handle_batch)`` and wait for it.

    ``available_now`` processes what is there and stops (tests, back-fills); otherwise
    one micro-batch every ``processing_time`` (the 2-minute cadence), one at a time.
    """
    spark = stream.sparkSession
    ckpt = checkpoint or fresh_dir(spark, "streams", name)
    w = stream.writeStream.queryName(f"{name}_{ckpt[-8:]}").option("checkpointLocation", ckpt) \
        .foreachBatch(handle_batch)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q


def run_ingest_stream(job, every: str = "2 minutes", clock=None, checkpoint: str | None = None):
    """Growing-file ingest on a timer: each micro-batch of a ``rate`` tick stream runs
    one ``IngestJob.run`` (listing -> size watermark -> re-read of changed files ->
    merge). Spark's file source would not see rows appended to a file it already
    listed, hence the tick. Micro-batches never overlap (one run at a time) and a
    late trigger does not queue missed runs (no catch-up).

    ``clock`` returns the run time as 'YYYY-MM-DD HH:MM:SS' (default: UTC now).
    Returns the started query; stop it with ``query.stop()``.
    """
    import datetime as dt

    spark = job.spark
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def handle(batch: DataFrame, batch_id: int):
        now = clock() if clock else dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        job.run(now)

    ckpt = checkpoint or fresh_dir(spark, "streams", "ingest_ticks")
    return (ticks.writeStream.queryName(f"ingest_ticks_{ckpt[-8:]}")
            .option("checkpointLocation", ckpt).foreachBatch(handle)
            .trigger(processingTime=every).start())
