"""Row transformations shared by batch ingest, streaming ingest and the audit.

``clean_hourly`` turns header-mapped string rows of the hourly log into typed table
rows; ``hourly_log_keys`` / ``plate_log_keys`` turn raw log rows into the audit's
(line, audited_date, key) shape; ``*_table_rows`` do the same for stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.functions.calendar import event_date
from vitrine.functions.clean import (audit_id, composite_key, event_time, log_time,
                                     scan_position, to_bigint, to_category,
                                     to_double, time_of_day)
from vitrine.operators.sequence import with_event_seq
from vitrine.spec import CUT2_SCHEMA, EXTRACTION_COLUMN, MEASUREMENT_COLUMNS

__all__ = ["clean_hourly", "sequence_hourly", "zero_id_rule", "hourly_log_keys",
           "plate_log_keys", "plate_table_rows", "hourly_table_rows", "FILE_COLUMNS"]

# Columns every scanned row carries besides the log fields.
FILE_COLUMNS = ("file_key", "file_date", "load_order", "block_start", "row_pos")


def clean_hourly(raw: DataFrame, run_ts, require_all: bool = True, keep=()) -> DataFrame:
    """Typed hourly-log rows (without event_seq) from header-mapped text rows.

    raw: normalised text columns (time, lite_id, cap_id, measurements, total_result)
         plus FILE_COLUMNS. Missing measurement columns are an error unless
         ``require_all`` is False (then they are NULL).
    """
    have = set(raw.columns)

    def text(c):
        if c in have:
            return F.col(c)
        if require_all:
            raise ValueError(f"missing column {c}")
        return F.lit(None).cast("string")

    cols = [
        event_time(F.col("file_date"), text("time")).alias("time"),
        to_bigint(text("lite_id")).alias("lite_id"),
        to_bigint(text("cap_id")).alias("cap_id"),
    ]
    cols += [to_double(text(c)).alias(c) for c in MEASUREMENT_COLUMNS]
    cols += [to_category(text("total_result")).alias("total_result")]
    out = raw.select(*[F.col(c) for c in FILE_COLUMNS if c in have],
                     *[F.col(c) for c in keep if c in have], *cols)
    out = out.withColumn("scan_position", scan_position("cap_id", "lite_id"))
    return out.withColumn(EXTRACTION_COLUMN, F.lit(run_ts).cast("timestamp_ntz"))


def sequence_hourly(rows: DataFrame, split_col: str | None = "block_start", parts: int | None = None) -> DataFrame:
    """event_seq per file and (cap_id, lite_id, time), in physical order."""
    return with_event_seq(rows, ["cap_id", "lite_id", "time"], ["block_start", "row_pos"],
                          scope_cols=["file_key"], split_col=split_col, parts=parts)


def table_exprs() -> list:
    """Target schema columns (cast, in table order) plus the day/hour partition columns."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CUT2_SCHEMA.fields]
    return cols + [event_date("time").alias("event_date"), F.hour("time").alias("event_hour")]


def zero_id_rule(df: DataFrame, enabled: bool = False, col: str = "lite_id") -> DataFrame:
    """Optional removal of fake 0 IDs (off by default; count them with a report first)."""
    return df.where(F.col(col).isNull() | (F.col(col) != 0)) if enabled else df


def computed(df: DataFrame, keep, **exprs) -> DataFrame:
    """Evaluate ``exprs`` once per row and keep them as columns.

    A filter on a plain projected column is pushed below the projection by the
    optimizer and re-evaluates the (expensive) parsing expression there, possibly
    in an earlier, less parallel stage. Producing the columns from a one-row
    generator keeps later filters above it, so each parse runs exactly once.
    """
    st = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select(*keep, F.inline(F.array(st)))


def plate_log_keys(raw: DataFrame, date_col: str = "Date", key_col: str = "GrpID",
                   typed: bool = True, date_sep: str = "/") -> DataFrame:
    """Plate-log rows -> (line, audited_date, key): blank date/ID dropped, fraction of
    seconds stripped, unparseable times dropped, ID decimals removed."""
    d, k = F.trim(F.col(date_col)), F.trim(F.col(key_col))
    rows = computed(raw.where((d != "") & (k != "")), ["line"],
                    _ts=log_time(F.col(date_col), date_sep=date_sep), key=audit_id(F.col(key_col), typed))
    return rows.where(F.col("_ts").isNotNull()) \
        .select("line", F.to_date("_ts").alias("audited_date"), "key")


def hourly_log_keys(raw: DataFrame, time_col: str = "time", lite_col: str = "lite_id",
                    cap_col: str = "cap_id", order_cols=("file_hour", "block_start", "row_pos"),
                    typed: bool = True, parts: int | None = None) -> DataFrame:
    """Hourly-log rows -> composite keys 'cap|lite|HH:MM:SS|seq', the counter running
    over all files of the audited day (rows of other days do not advance it)."""
    t, lite = F.trim(F.col(time_col)), F.trim(F.col(lite_col))
    ts = log_time(F.col(time_col), date_col=F.col("file_date"))
    cap_k, lite_k = audit_id(F.col(cap_col), typed), audit_id(F.col(lite_col), typed)
    rows = computed(raw.where(F.coalesce(t, F.lit("")) != "").where(F.coalesce(lite, F.lit("")) != ""),
                    order_cols, line=F.col("line"), _ts=ts, _cap=cap_k, _lite=lite_k) \
        .where(F.col("_ts").isNotNull()) \
        .withColumn("audited_date", F.to_date("_ts")) \
        .withColumn("_tod", time_of_day("_ts"))
    # split = (file, split start): a hot key is numbered split by split, never whole
    rows = rows.withColumn("_split", F.struct(*order_cols[:-1]))
    rows = with_event_seq(rows, ["_cap", "_lite", "_tod"], ["_split", order_cols[-1]],
                          scope_cols=["line", "audited_date"], split_col="_split", out="_seq", parts=parts)
    return rows.select("line", "audited_date",
                       composite_key("_cap", "_lite", "_ts", "_seq").alias("key"))


def plate_table_rows(table: DataFrame, line: str, date_col: str, key_col: str,
                     typed: bool = True) -> DataFrame:
    """Stored plate rows; their IDs take the same canonical form as the log's. Numbers go
    through DECIMAL, so a DOUBLE 1.0E7 prints as 10000000."""
    col = F.col(key_col)
    if dict(table.dtypes)[key_col] in ("double", "float"):
        col = col.cast("decimal(38,6)")
    return table.select(F.lit(line).alias("line"), F.to_date(F.col(date_col)).alias("audited_date"),
                        audit_id(col, typed).alias("key"))


def hourly_table_rows(table: DataFrame, line: str) -> DataFrame:
    """Stored hourly rows -> composite keys; rows without lite_id count but have no key."""
    key = F.when(F.col("lite_id").isNotNull(),
                 composite_key("cap_id", "lite_id", "time", "event_seq"))
    return table.select(F.lit(line).alias("line"), F.to_date("time").alias("audited_date"),
                        key.alias("key"))


