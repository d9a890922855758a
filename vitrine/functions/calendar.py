"""Calendar expressions: day routing, quarter ranges, labels.

Every function takes its reference date as a column or literal; nothing reads the
wall clock, so re-runs and back-fills are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.spec import (ARCHIVE_LOOKBACK_DAYS, ARCHIVE_PERIOD_SEPARATOR,
                          TRANSITION_WINDOW_MINUTES, WATERMARK_KEY_PREFIX)

__all__ = [
    "event_date", "day_start", "next_day_start", "partition_label", "quarter_start",
    "quarter_end", "period_label", "watermark_key", "hour_start", "transition_hours",
    "as_date",
]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_date(value) -> Column:
    """A date literal from 'YYYY-MM-DD' / date, or a column cast to DATE."""
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def event_date(ts) -> Column:
    """Calendar day of an event time: the day partition it routes to."""
    return F.to_date(_c(ts))


def day_start(day) -> Column:
    """Lower bound of the half-open day range [D 00:00, D+1 00:00)."""
    return _c(day).cast("timestamp_ntz")


def next_day_start(day) -> Column:
    return F.date_add(_c(day), 1).cast("timestamp_ntz")


def partition_label(table: str, day) -> Column:
    """'{table}_{YYYY_MM_DD}'."""
    return F.concat(F.lit(f"{table}_"), F.date_format(_c(day), "yyyy_MM_dd"))


def quarter_start(as_of, lookback_days: int = ARCHIVE_LOOKBACK_DAYS) -> Column:
    """First day of the quarter that holds ``as_of - lookback_days``."""
    return F.trunc(F.date_sub(as_date(as_of), lookback_days), "quarter")


def quarter_end(as_of, lookback_days: int = ARCHIVE_LOOKBACK_DAYS) -> Column:
    return F.date_sub(F.add_months(quarter_start(as_of, lookback_days), 3), 1)


def period_label(start, end) -> Column:
    """'{start}_a_{end}' with ISO dates."""
    return F.concat(_c(start).cast("string"), F.lit(ARCHIVE_PERIOD_SEPARATOR),
                    _c(end).cast("string"))


def hour_start(ts) -> Column:
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")


def watermark_key(hour_ts) -> Column:
    """'watermark_cut2_YYYYMMDD_HH' for the hourly file that starts at ``hour_ts``."""
    return F.concat(F.lit(WATERMARK_KEY_PREFIX), F.date_format(_c(hour_ts), "yyyyMMdd_HH"))


def transition_hours(run_ts, window_minutes: int = TRANSITION_WINDOW_MINUTES) -> Column:
    """Hour files an ingest run at ``run_ts`` reads: its own hour, plus the previous hour
    while ``minute < window_minutes``. Returns array<timestamp_ntz>, current first."""
    cur = hour_start(run_ts)
    prev = (cur - F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")
    return F.when(F.minute(_c(run_ts)) < window_minutes, F.array(cur, prev)).otherwise(F.array(cur))
