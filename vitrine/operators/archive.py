"""Quarter archiving: range, scan, per-day counts, validation and retention choice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.spec import ARCHIVE_LOOKBACK_DAYS

__all__ = ["quarter_range", "archive_scan", "day_counts", "day_fingerprints", "validate_counts", "retention_keep"]


def quarter_range(as_of: dt.date | str, lookback_days: int = ARCHIVE_LOOKBACK_DAYS,
                  refuse_open: bool = True) -> tuple[dt.date, dt.date]:
    """(first, last) day of the quarter holding ``as_of - lookback_days``.

    From the 16th day of a quarter on, that is the current, still open quarter; with
    ``refuse_open`` such a range is refused instead of archived.
    """
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    base = as_of - dt.timedelta(days=lookback_days)
    q0 = 3 * ((base.month - 1) // 3) + 1
    start = dt.date(base.year, q0, 1)
    nxt = dt.date(base.year + (q0 + 3 > 12), (q0 + 2) % 12 + 1, 1)
    end = nxt - dt.timedelta(days=1)
    if refuse_open and end >= as_of:
        raise ValueError(f"quarter {start}..{end} is not closed on {as_of}")
    return start, end


def archive_scan(df: DataFrame, start, end, day_col: str = "event_date") -> DataFrame:
    """Rows whose day lies in [start, end] (inclusive); prunes day partitions."""
    return df.where(F.col(day_col).between(F.lit(str(start)).cast("date"),
                                           F.lit(str(end)).cast("date")))


def day_counts(df: DataFrame, day_col: str = "event_date", name: str = "rows") -> DataFrame:
    return df.groupBy(F.col(day_col).alias("day")).agg(F.count(F.lit(1)).alias(name))


def day_fingerprints(df: DataFrame, columns: list[str], day_col: str = "event_date", name: str = "rows") -> DataFrame:
    """Rows per day, and a fingerprint of their contents that no order of rows changes: the xor
    and the sum of the row hashes (a row stored twice cancels out of the one, not of the other).
    Both are combined before the shuffle; nothing but one row a day leaves a task."""
    row = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns])
    return df.groupBy(F.col(day_col).alias("day")).agg(
        F.count(F.lit(1)).alias(name),
        F.struct(F.bit_xor(row), F.sum(row.bitwiseAND(F.lit(0xFFFFFFFF)))).alias(f"{name}_print"))


def validate_counts(source: DataFrame, archive: DataFrame, day_col: str = "event_date"
                    ) -> DataFrame:
    """Per day: source rows vs archived rows; a day may be dropped only when their number and
    their contents are equal. A column that the copy lacks makes every day invalid."""
    columns = sorted(source.columns)
    if set(columns) - set(archive.columns):
        archive = archive.limit(0).select(*archive.columns, *[F.lit(None).alias(c) for c in set(columns) - set(archive.columns)])
    s = day_fingerprints(source, columns, day_col, "source_rows")
    a = day_fingerprints(archive, columns, day_col, "archived_rows")
    j = s.join(a, "day", "full_outer")
    return j.select("day", F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                    F.coalesce("archived_rows", F.lit(0)).alias("archived_rows"),
                    F.col("source_rows_print").eqNullSafe(F.col("archived_rows_print")).alias("valid"))


def retention_keep(df: DataFrame, start, end, day_col: str = "event_date") -> DataFrame:
    """What stays after the archived days are dropped."""
    return df.where(~F.col(day_col).between(F.lit(str(start)).cast("date"),
                                            F.lit(str(end)).cast("date"))
                    | F.col(day_col).isNull())
