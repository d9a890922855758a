"""Archive job: closed quarter -> Snappy Parquet -> count check -> drop validated days."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators import archive as arch
from vitrine.plans.tables import LakeTable
from vitrine.spec import ARCHIVE_CODEC, ARCHIVE_PERIOD_SEPARATOR, ARCHIVE_TABLES

__all__ = ["ArchiveFailed", "archive_quarter", "archive_registry", "with_event_date"]


class ArchiveFailed(RuntimeError):
    """Some tables were not archived; ``results`` holds what was done for every table."""

    def __init__(self, errors: dict, results: dict):
        super().__init__("; ".join(f"{name}: {why}" for name, why in errors.items()))
        self.errors, self.results = errors, results


def with_event_date(rows: DataFrame, table_name: str, day_col: str = "event_date") -> DataFrame:
    """Rows of a registered table with the day partition made from the table's own time
    column (date, time, Time or starttime)."""
    return rows.withColumn(day_col, F.to_date(F.col(ARCHIVE_TABLES[table_name])))


def archive_registry(spark: SparkSession, root: str, base: str, as_of: str | dt.date,
                     drop: bool = True) -> dict:
    """``archive_quarter`` of every registered table that exists below ``root``. A table that
    fails or has invalid days does not stop the others; ``ArchiveFailed`` is raised at the end."""
    out, errors = {}, {}
    for name in ARCHIVE_TABLES:
        table = LakeTable(spark, f"{root.rstrip('/')}/{name}")
        if table.exists():
            try:
                out[name] = archive_quarter(spark, table, name, base, as_of, drop=drop)
                if out[name]["invalid_days"]:
                    errors[name] = f"days not equal to their copy: {out[name]['invalid_days']}"
            except Exception as exc:  # noqa: BLE001 - raised below; nothing of this table was dropped
                errors[name] = str(exc)
    if errors:
        raise ArchiveFailed(errors, out)
    return out


def archive_quarter(spark: SparkSession, table: LakeTable, table_name: str, base: str,
                    as_of: str | dt.date, day_col: str = "event_date", drop: bool = True,
                    after_write: Callable[[str], None] | None = None) -> dict:
    """Export the previous quarter of ``table`` and remove the days that were verified.

    * the period is the quarter of ``as_of - 15 days``; an open quarter is refused;
    * output ``{base}/{table}/{start}_a_{end}/``, day-partitioned, replacing any
      partial output of an earlier attempt;
    * verification re-reads the written files and compares the number and the contents of
      the rows per day with the source; only equal days are dropped, each as a whole partition.
      ``after_write`` is called with the archive's path before that (tests change a file there).
    """
    start, end = arch.quarter_range(as_of)
    period = f"{start}{ARCHIVE_PERIOD_SEPARATOR}{end}"
    out = f"{base.rstrip('/')}/{table_name}/{period}"
    src = table.read_days(start, end, day_col)
    (src.write.mode("overwrite").option("compression", ARCHIVE_CODEC)
     .partitionBy(day_col).parquet(out))
    if after_write is not None:
        after_write(out)
    archived = spark.read.parquet(out)
    checks = arch.validate_counts(src, archived, day_col).orderBy("day").collect()
    totals = archived.agg(F.count(F.lit(1)).alias("rows"),
                          F.countDistinct(day_col).alias("partitions")).first()
    valid_days = [r["day"] for r in checks if r["valid"] and r["source_rows"] > 0]
    dropped = table.drop_days(valid_days, day_col) if drop else []
    return {
        "period": period, "path": out, "rows": int(totals["rows"]),
        "partitions": int(totals["partitions"]),
        "deleted_per_day": {str(r["day"]): int(r["source_rows"]) for r in checks
                            if r["day"] in dropped},
        "deleted_total": int(sum(r["source_rows"] for r in checks if r["day"] in dropped)),
        "invalid_days": [str(r["day"]) for r in checks if not r["valid"]],
    }
