"""Rows that come after the late-data bound, kept beside the stream that drops them.

A stateful operator drops rows whose event time is not above the watermark, which is the
largest event time of all earlier micro-batches less the delay. The operator only counts them.
``LateRows`` follows the same bound in a small log of its own (one row per micro-batch: the
largest event time it held) and writes what is not above it to a side table. The bound of a
micro-batch depends on earlier ones alone and each batch overwrites its own folder, so a batch
that runs again after a failure gives the same side rows.

``run_with_late_rows`` runs both on the same source: the stateful query with its sink, and the
side query. The number of side rows is then checked against what the engine says it dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.plans.tables import path_exists
from vitrine.streaming.ingest import run_micro_batches

__all__ = ["LateRows", "dropped_by_watermark", "run_with_late_rows"]

#: Rows whose batch has no bound yet (nothing came before it) lie above this one.
NO_BOUND = -(1 << 62)


class LateCountDiffers(RuntimeError):
    pass


@dataclass
class LateRows:
    """Side table and bound log of one stream, below ``path``."""

    spark: SparkSession
    path: str
    delay_minutes: int
    time_col: str = "event_time"

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        return self.spark.read.schema(schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], schema)

    def bound(self, batch_id: int) -> int:
        """Micros since 1970 up to which rows of this batch are late."""
        seen = self._read("bounds", "newest bigint, batch bigint").where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        # the engine keeps its watermark in whole milliseconds
        return NO_BOUND if seen is None else (seen // 1000 - self.delay_minutes * 60_000) * 1000

    def split(self, batch: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """(on time, late) rows of a micro-batch. A row without event time is never late."""
        late = F.coalesce(F.unix_micros(self.time_col) <= self.bound(batch_id), F.lit(False))
        return batch.where(~late), batch.where(late)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """The batch's late rows go to the side table, then its largest event time to the log."""
        late = self.split(batch, batch_id)[1].withColumn("late_by_us", F.lit(self.bound(batch_id)) - F.unix_micros(self.time_col))
        late.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        newest = batch.agg(F.max(F.unix_micros(self.time_col)).alias("newest")).where(F.col("newest").isNotNull())
        newest.write.mode("overwrite").parquet(f"{self.path}/bounds/batch={batch_id}")

    def rows(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/rows")


def dropped_by_watermark(query) -> int:
    """Rows that the query's stateful operators say they dropped since it was started."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_with_late_rows(stream: DataFrame, stateful: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None],
                       late: LateRows, checkpoint: str, name: str) -> int:
    """Process what is new in ``stream``: ``stateful(stream with its watermark)`` into ``sink``
    (which evaluates a batch once), and the late rows into their side table. Returns how many there were; raises when the engine
    dropped another number."""
    before = late.rows().count() if path_exists(late.spark, f"{late.path}/rows") else 0
    marked = stream.withWatermark(late.time_col, f"{late.delay_minutes} minutes")
    query = run_micro_batches(stateful(marked), sink, name, checkpoint=f"{checkpoint}/kept")
    run_micro_batches(stream, late.write, f"{name}_late", checkpoint=f"{checkpoint}/late")
    found, dropped = late.rows().count() - before, dropped_by_watermark(query)
    if found != dropped:
        raise LateCountDiffers(f"{name}: {found} rows in the side table, {dropped} dropped by the engine")
    return found
