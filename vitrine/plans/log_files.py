"""Machine logs as files: the sink that turns rows of lines into hourly or plate logs.

A log is one sequential text with its header first, so each file is written by one task, in
order; files are dealt over the tasks. The parts are then moved to the machines' own paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.session import fresh_dir
from vitrine.sources.fs import delete_path, glob_paths, move_file

__all__ = ["write_hourly_logs", "write_plate_logs", "log_line"]


def log_line(sep: str, *fields) -> Column:
    """Fields joined by ``sep``; a NULL field is empty."""
    return F.concat_ws(sep, *[F.coalesce((F.col(f) if isinstance(f, str) else f).cast("string"), F.lit("")) for f in fields])


def _write(lines: DataFrame, name: Column, root: str, target) -> list[str]:
    spark = lines.sparkSession
    parts = fresh_dir(spark, "staging", "log_parts")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (lines.select(name.alias("file"), "place", "line").repartition(tasks, "file").sortWithinPartitions("file", "place")
     .select(F.col("line").alias("value"), "file").write.partitionBy("file").text(parts))
    out = []
    for part in glob_paths(spark, f"{parts}/file=*/part-*"):
        out.append(f"{root.rstrip('/')}/{target(part.split('/file=')[1].split('/')[0])}")
        move_file(spark, part, out[-1])
    delete_path(spark, parts)
    return sorted(out)


def write_hourly_logs(lines: DataFrame, root: str) -> list[str]:
    """Rows (file_hour, place, line) -> ``root/YYYY/MM/DD/HH.csv``, lines by place. Returns the paths."""
    return _write(lines, F.date_format("file_hour", "yyyy-MM-dd-HH"), root, lambda f: "/".join(f.split("-")) + ".csv")


def write_plate_logs(lines: DataFrame, root: str) -> list[str]:
    """Rows (file_date, place, line) -> ``root/YYYY-MM/YYYY-MM-DD-PlateLog.txt``, lines by place."""
    return _write(lines, F.date_format("file_date", "yyyy-MM-dd"), root, lambda f: f"{f[:7]}/{f}-PlateLog.txt")
