"""Header-mapped readers for delimited machine logs.

Spark's CSV reader maps columns by position, but machines reorder, add and drop columns between
firmware versions; a multi-file read would then silently swap values. The reader here reads
every log once, as lines, and maps each row by its own file's header:

1. ``scan_lines`` writes the lines of all selected files with their path, split start and row
   position -- the physical order that ``event_seq`` needs -- in one pass over the bytes. Every
   later step reads that copy.
2. The first line of the split at byte 0 is the file's header. Only the *distinct* headers (a
   handful of firmware versions, whatever the number of files) reach the driver, which turns
   each into a layout: width, and the place of every wanted column. Files get their layout back
   by joining on the header text.
3. Rows join their file's layout, are split into fields, and every wanted column is taken from
   the place that the layout names. Several layouts so go through one plan.

Validation: a file whose normalised header lacks a required column, or names one twice, is
rejected before any row is mapped. Corrupt rows (another number of fields than the header, or
invalid UTF-8) fail their whole file by default, like the source loader;
``on_corrupt='quarantine'`` keeps the rest of the file; ``on_corrupt='flag'`` returns every row
with a ``_corrupt`` column, so a caller that materialises the result can apply the file policy
itself. Blank lines are no rows. A field may be quoted with ``"`` (doubled inside it), an empty
field is NULL.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.clean import normalize_name
from vitrine.session import fresh_dir
from vitrine.sources.fs import delete_path
from vitrine.sources.listing import hourly_file_columns, plate_file_columns

__all__ = ["scan_lines", "split_fields", "layout_of", "read_log", "LogRead", "split_header", "path_key"]

EMPTY_REASON = "empty file or no header"
CORRUPT_REASON = "corrupt rows (ragged row or invalid UTF-8)"


@dataclass
class LogRead:
    rows: DataFrame          # normalised text columns + file columns
    rejected: DataFrame      # (path, reason) files that contribute no rows
    corrupt: DataFrame       # (path, row_pos, raw) rows flagged corrupt
    copies: tuple[str, ...] = ()  # written lines and layouts that the three read

    def release(self) -> None:
        """Remove the written lines, once nothing reads them any more."""
        for path in self.copies:
            delete_path(self.rows.sparkSession, path)


def split_header(line: str, sep: str) -> list[str]:
    parts = (line or "").lstrip("\ufeff").rstrip("\r\n").split(sep)
    return [p.strip().strip('"').strip() for p in parts]


def split_fields(line: Column, sep: str) -> Column:
    """Fields of a line; quotes around a field go, doubled quotes inside it become one. Lines
    without a quote take the plain split."""
    one = re.escape(sep)
    plain = F.split(line, f"\\Q{sep}\\E")
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(f'{one}("(?:[^"]|"")*"[^{one}]*|[^{one}]*)'), F.lit(1))
    bare = F.transform(found, lambda f: F.when(f.startswith('"'), F.replace(F.regexp_replace(f, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(f))
    return F.when(F.instr(line, '"') > 0, bare).otherwise(plain)


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, block_start, row_pos, raw) of every line that is not blank; row positions grow
    inside a split, splits follow each other by their start."""
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_pos"), F.col("value").alias("raw")).where(F.trim("raw") != "")


def layout_of(header: str, sep: str, required, wanted) -> tuple[int, list[int | None], str | None]:
    """(number of fields, place of each wanted column, why the file is rejected)."""
    names = [normalize_name(x) for x in split_header(header, sep)]
    dup = sorted(n for n, c in Counter(names).items() if c > 1 and n)
    missing = [c for c in required if c not in names]
    reason = f"Duplicate columns in CSV: {dup}" if dup else f"Missing columns in CSV: {missing}" if missing else None
    return len(names), [names.index(c) if c in names else None for c in wanted], reason


def path_key(p: str) -> str:
    """file:/x, file:///x and /x name the same local file."""
    for pre in ("file:///", "file:/"):
        if p.startswith(pre):
            return "/" + p[len(pre):].lstrip("/")
    return p


def _path_key(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def read_log(spark: SparkSession, paths: list[str], sep: str, required: tuple[str, ...],
             kind: str = "hourly", on_corrupt: str = "fail_file",
             wanted: tuple[str, ...] | None = None, strict_utf8: bool = True) -> LogRead:
    """Read delimited logs by header name.

    kind: 'hourly' (path YYYY/MM/DD/HH.csv) or 'plate' (path YYYY-MM/YYYY-MM-DD-PlateLog.txt)
          decides how file_date / file_hour / file_key are derived from the path.
    required: normalised names every file must have.
    wanted: normalised names to return (default: required); extra columns are ignored.
    strict_utf8: invalid bytes make a row corrupt (loader behaviour); when False they are
          decoded lossily (U+FFFD) and the row is kept (audit behaviour).
    """
    wanted = tuple(wanted or required)
    flag = ", _corrupt boolean" if on_corrupt == "flag" else ""
    if not paths:
        return LogRead(spark.createDataFrame([], _empty_schema(wanted) + flag), spark.createDataFrame([], "path string, reason string"),
                       spark.createDataFrame([], "path string, row_pos bigint, raw string"))
    copy = fresh_dir(spark, "staging", "log_lines")
    scan_lines(spark, paths).write.parquet(f"{copy}/lines")
    lines = spark.read.parquet(f"{copy}/lines")
    heads = (lines.where(F.col("block_start") == 0).groupBy("path")
             .agg(F.min("row_pos").alias("head_pos"), F.make_valid_utf8(F.min_by("raw", "row_pos")).alias("header")))
    layouts = [(r["header"], *layout_of(r["header"], sep, required, wanted)) for r in heads.select("header").distinct().collect()]
    heads.join(spark.createDataFrame(layouts, "header string, width int, places array<int>, reason string"), "header") \
        .drop("header").write.parquet(f"{copy}/files")
    files = spark.read.parquet(f"{copy}/files")

    file_cols = hourly_file_columns if kind == "hourly" else plate_file_columns
    text = F.col("raw") if strict_utf8 else F.make_valid_utf8("raw")
    mapped = (lines.join(files.where(F.col("reason").isNull()), "path")
              .where((F.col("block_start") > 0) | (F.col("row_pos") > F.col("head_pos")))
              .select("path", "block_start", "row_pos", "raw", "width", "places", split_fields(text, sep).alias("fields")))
    bad = F.size("fields") != F.col("width")
    if strict_utf8:
        bad = bad | ~F.is_valid_utf8("raw")
    # The flag is made before the ~30 fields get their names: constraint inference explodes on
    # a filter over that many renamed fields.
    mapped = mapped.withColumn("_corrupt", bad)
    corrupt = mapped.where("_corrupt").select("path", "row_pos", F.make_valid_utf8("raw").alias("raw"))

    def field(k: int) -> Column:
        value = F.get("fields", F.col("places")[k])
        return F.when(value != "", value)

    kept = mapped.where(~F.col("_corrupt")) if on_corrupt == "quarantine" else mapped
    rows = kept.select("path", *file_cols(F.col("path")), "block_start", "row_pos", *[field(k).alias(c) for k, c in enumerate(wanted)],
                       *(["_corrupt"] if flag else []))
    given = spark.createDataFrame([(p, path_key(p)) for p in paths], "path string, own string")
    seen = files.select(_path_key(F.col("path")).alias("own"), "reason")
    rejected = (given.join(seen.withColumn("seen", F.lit(True)), "own", "left").where(F.col("seen").isNull() | F.col("reason").isNotNull())
                .select("path", F.coalesce("reason", F.lit(EMPTY_REASON)).alias("reason")))
    if on_corrupt == "raise":
        if corrupt.limit(1).count():
            raise ValueError("corrupt rows found; see LogRead.corrupt")
    elif on_corrupt == "fail_file":  # a file with any corrupt row contributes nothing
        bad_files = corrupt.select("path").distinct()
        rows = rows.join(bad_files, "path", "left_anti")
        rejected = rejected.unionByName(bad_files.select("path", F.lit(CORRUPT_REASON).alias("reason")))
    return LogRead(rows, rejected, corrupt, (copy,))


def _empty_schema(wanted) -> str:
    cols = ["path string", "file_date date", "file_hour timestamp_ntz", "file_key string",
            "block_start bigint", "row_pos bigint"] + [f"`{c}` string" for c in wanted]
    return ", ".join(cols)
