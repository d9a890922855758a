"""File listing with sizes and path-derived dates (no file content is read).

Listings of a day range look into that range's folders only: the folder names are made from
the days, one glob a month finds those that exist, and Spark's file index lists them in
parallel. History outside the range costs nothing.

``binaryFile`` prunes the ``content`` column from the scan when it is not selected, so
a listing costs one metadata lookup per file and runs on the cluster's file index.
"""

from __future__ import annotations

import datetime as dt
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.calendar import transition_hours, watermark_key
from vitrine.sources.fs import glob_paths, path_exists
from vitrine.spec import HOURLY_PATH_REGEX, PLATE_PATH_REGEX

__all__ = ["list_files", "hourly_day_folders", "plate_day_files", "hourly_file_columns", "plate_file_columns", "list_hourly_logs",
           "list_plate_logs", "select_ingest_files", "select_hourly_audit_files",
           "select_plate_audit_files"]


def _months(start, end) -> list[tuple[str, str, list[str]]]:
    """(year, month, days) of the range, as the two- and four-digit texts of the paths."""
    first, last = dt.date.fromisoformat(str(start)), dt.date.fromisoformat(str(end))
    days = [first + dt.timedelta(n) for n in range((last - first).days + 1)]
    return [(f"{y:04d}", f"{m:02d}", [f"{x.day:02d}" for x in own]) for (y, m), own in groupby(days, lambda x: (x.year, x.month))]


def hourly_day_folders(spark: SparkSession, root: str, start, end) -> list[str]:
    """Existing ``root/YYYY/MM/DD`` folders of the days [start, end]; one look-up a month."""
    base = root.rstrip("/")
    return [p for y, m, days in _months(start, end) for p in glob_paths(spark, f"{base}/{y}/{m}/{{{','.join(days)}}}")]


def plate_day_files(spark: SparkSession, root: str, start, end) -> list[str]:
    """Existing ``root/YYYY-MM/YYYY-MM-DD-PlateLog.txt`` files of the days [start, end]."""
    base = root.rstrip("/")
    return [p for y, m, days in _months(start, end)
            for p in glob_paths(spark, f"{base}/{y}-{m}/{{{','.join(f'{y}-{m}-{x}' for x in days)}}}-PlateLog.txt")]


def list_files(spark: SparkSession, root: str | list[str], name_glob: str) -> DataFrame:
    """(path, size, modified) for every file under ``root`` (a folder, or existing folders and
    files) whose name matches; empty when there is none (a line without any log yet)."""
    if not (root if isinstance(root, list) else path_exists(spark, root)):
        return spark.createDataFrame([], "path string, size bigint, modified timestamp")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", name_glob).load(root)
            .select("path", F.col("length").alias("size"),
                    F.col("modificationTime").alias("modified")))


def hourly_file_columns(path: Column) -> list[Column]:
    """file_date, file_hour, file_key from '.../YYYY/MM/DD/HH.csv'."""
    y, m, d, h = [F.regexp_extract(path, HOURLY_PATH_REGEX, i) for i in (1, 2, 3, 4)]
    day = F.concat_ws("-", y, m, d).try_cast("date")
    hour = F.concat(F.concat_ws("-", y, m, d), F.lit(" "), h, F.lit(":00:00")).try_cast("timestamp_ntz")
    return [day.alias("file_date"), hour.alias("file_hour"), watermark_key(hour).alias("file_key")]


def plate_file_columns(path: Column) -> list[Column]:
    """file_date and file_key from '.../YYYY-MM/YYYY-MM-DD-PlateLog.txt'."""
    day = F.regexp_extract(path, PLATE_PATH_REGEX, 3).try_cast("date")
    return [day.alias("file_date"), day.cast("timestamp_ntz").alias("file_hour"),
            F.regexp_extract(path, r"([^/]+)$", 1).alias("file_key")]


def list_hourly_logs(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Hourly logs of the days [start, end], or of all days."""
    where = root if start is None else hourly_day_folders(spark, root, start, end or start)
    f = list_files(spark, where, "*.csv")
    return f.select("*", *hourly_file_columns(F.col("path"))).where(F.col("file_date").isNotNull())


def list_plate_logs(spark: SparkSession, root: str, start=None, end=None) -> DataFrame:
    """Plate logs of the days [start, end], or of all days."""
    where = root if start is None else plate_day_files(spark, root, start, end or start)
    f = list_files(spark, where, "*-PlateLog.txt")
    return f.select("*", *plate_file_columns(F.col("path"))).where(F.col("file_date").isNotNull())


def select_ingest_files(listing: DataFrame, run_ts: str, window_minutes: int | None = None
                        ) -> DataFrame:
    """Files an ingest run at ``run_ts`` looks at: the current hour, plus the previous hour
    inside the transition window. Files are applied by ``load_order``: 0 is the current hour,
    the previous one is applied over it (and so wins on conflicts)."""
    kw = {} if window_minutes is None else {"window_minutes": window_minutes}
    hours = transition_hours(F.lit(run_ts).cast("timestamp_ntz"), **kw)
    pos = F.array_position(hours, F.col("file_hour"))
    return listing.where(pos > 0).withColumn("load_order", (pos - 1).cast("int"))


def select_hourly_audit_files(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Hourly files for audited days [start, end]: every hour of those days plus the
    00 file of the following day (rows written just after midnight)."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    d = F.col("file_date")
    keep = d.between(s, e) | ((d == F.date_add(e, 1)) & (F.hour("file_hour") == 0))
    return listing.where(keep)


def select_plate_audit_files(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Plate logs for audited days [start, end] plus the next day's file (late rows)."""
    s, e = F.lit(start).cast("date"), F.lit(end).cast("date")
    return listing.where(F.col("file_date").between(s, F.date_add(e, 1)))
