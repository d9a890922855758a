"""Column expressions for cleaning machine log fields.

All functions return ``Column`` objects built from built-in functions, so they run
inside whole-stage code generation; nothing here touches Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.spec import (IDS_TEXT_LIMIT, INVALID_MARKERS, ROLLOVER_MODULUS,
                          TRUNCATION_SUFFIX)

__all__ = [
    "normalize_name", "trimmed", "null_markers", "to_double", "to_bigint",
    "to_category", "event_time", "log_time", "scan_position", "canonical_id", "audit_id", "time_of_day",
    "composite_key", "bounded_text", "py_list_text", "DOUBLE_TEXT", "BIGINT_TEXT",
]

# A number the way the machine writes it: optional sign, digits with an optional
# point, optional exponent; plus nan/inf spellings, which are numbers, not markers.
DOUBLE_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NONFINITE_TEXT = r"^(?i)[+-]?(nan|inf|infinity)$"
BIGINT_TEXT = r"^[+-]?[0-9]+$"
TIME_TEXT = r"^[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"
DATETIME_TEXT = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalize_name(name: str) -> str:
    """Header text -> snake_case: trim, lower, non-word runs -> '_', collapse, strip '_'."""
    s = re.sub(r"[^\w]+", "_", name.strip().lower())
    return re.sub(r"_+", "_", s).strip("_")


def trimmed(col) -> Column:
    """Trim blanks; the empty text becomes NULL."""
    t = F.trim(_c(col))
    return F.when(t != F.lit(""), t)


def null_markers(col, markers=INVALID_MARKERS) -> Column:
    """Trimmed text, NULL for blanks and for the firmware's invalid markers."""
    t = F.trim(_c(col))
    return F.when(~t.isin(list(markers)) & (t != F.lit("")), t)


def to_double(col, markers=INVALID_MARKERS, allow_nonfinite: bool = True) -> Column:
    """Text -> DOUBLE or NULL, never an error. Only plain decimal notation is a number
    (no '1.5d', '0x1p3', '1,5'); nan/inf spellings pass when ``allow_nonfinite``."""
    t = null_markers(col, markers)
    ok = t.rlike(DOUBLE_TEXT)
    if allow_nonfinite:
        ok = ok | t.rlike(NONFINITE_TEXT)
    return F.when(ok, t.try_cast("double"))


def to_bigint(col, markers=INVALID_MARKERS) -> Column:
    """Text -> BIGINT or NULL: '12.0' and overflow are NULL, '+5' is 5, '007' is 7."""
    t = null_markers(col, markers)
    return F.when(t.rlike(BIGINT_TEXT), t.try_cast("bigint"))


def to_category(col, markers=INVALID_MARKERS) -> Column:
    """Categorical text: trimmed, NULL for blank or marker."""
    return null_markers(col, markers)


def event_time(date_col, time_col) -> Column:
    """Event time = file date + 'H:M:S' text (no fraction) as TIMESTAMP_NTZ, else NULL."""
    t = F.trim(_c(time_col))
    s = F.concat_ws(" ", _c(date_col).cast("string"), t)
    return F.when(t.rlike(TIME_TEXT), s.try_cast("timestamp_ntz"))


def log_time(col, date_col=None, date_sep: str = "/") -> Column:
    """Audit-side time: strip any fraction; the date's parts are joined by the line's own
    ``date_sep`` ('/': 'y/M/d H:m:s'), any other spelling is NULL.

    With ``date_col`` the text holds only the time of day and the date is prefixed.
    """
    t = F.substring_index(F.trim(_c(col)), ".", 1)
    if date_col is not None:
        t = F.concat_ws(" ", _c(date_col).cast("string"), t)
    elif date_sep != "-":
        t = F.when(~t.contains("-"), F.replace(t, F.lit(date_sep), F.lit("-")))
    return F.when(t.rlike(DATETIME_TEXT), t.try_cast("timestamp_ntz"))


def scan_position(cap_col, lite_col, modulus: int = ROLLOVER_MODULUS) -> Column:
    """(cap - lite) mod 4096, never negative, NULL if either side is NULL.

    Reducing both sides first keeps ANSI mode from overflowing on extreme IDs; the
    modulus divides 2^64 so the result equals wrap-around subtraction.
    """
    m = F.lit(modulus)
    return F.pmod(F.pmod(_c(cap_col), m) - F.pmod(_c(lite_col), m), m)


def canonical_id(col) -> Column:
    """Log ID text: drop a decimal part ('123.0' -> '123'), trim."""
    return F.trim(F.substring_index(F.trim(_c(col)), ".", 1))


def audit_id(col, typed: bool = True) -> Column:
    """Canonical ID text of either side of the audit: decimals dropped, trimmed; with
    ``typed`` an integer spelling prints as the integer ('007' and '+7' are '7') and any
    other text stays as it is."""
    t = canonical_id(_c(col).cast("string"))
    return F.coalesce(to_bigint(t).cast("string"), t) if typed else t


def time_of_day(col) -> Column:
    return F.date_format(_c(col), "HH:mm:ss")


def composite_key(cap, lite, ts, seq) -> Column:
    """'cap|lite|HH:MM:SS|seq'; a NULL part prints as ''."""
    parts = [_c(cap).cast("string"), _c(lite).cast("string"), time_of_day(ts),
             _c(seq).cast("string")]
    return F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])


def bounded_text(col, limit: int = IDS_TEXT_LIMIT, suffix: str = TRUNCATION_SUFFIX) -> Column:
    c = _c(col)
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit), F.lit(suffix))) \
        .otherwise(c)


def py_list_text(arr) -> Column:
    """Render an array of strings the way a Python list of str prints: ['a', 'b']."""
    quoted = F.transform(_c(arr), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
