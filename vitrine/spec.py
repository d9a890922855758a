"""Fixed values, target schema and per-line configuration.

Everything in the block marked FIXED VALUES must stay equal to what the machines
and the downstream tables expect; changing one changes results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the source pipeline for identical results)
# ---------------------------------------------------------------------------

# Texts the inspection firmware writes for unusable measurements; after trimming,
# an exact, case-sensitive match becomes NULL.
INVALID_MARKERS = ("-1.#J", "1.#J", "NaN", "1.#QNAN", "-1.#IND", "-1.#INF", "1.#INF")

# Hourly log table: mandatory columns after header normalisation, in table order.
CUT2_COLUMNS = (
    "time", "lite_id", "cap_id", "event_seq", "scan_position", "convoy_id",
    "tolerance_nbr", "nominal_length", "nominal_width", "length_diff", "width_diff",
    "diagonal", "rectangularity", "rotation", "position", "leading_corner_left",
    "leading_edge", "leading_corner_right", "right_edge", "trailing_corner_right",
    "trailing_edge", "trailing_corner_left", "left_edge", "markings", "total_result",
    "top_curv", "top_dev", "rgt_curv", "rgt_dev", "btm_curv", "btm_dev",
    "lft_curv", "lft_dev",
)
COMPUTED_COLUMNS = ("event_seq", "scan_position")
ID_COLUMNS = ("lite_id", "cap_id")
TEXT_COLUMNS = ("total_result",)
EXTRACTION_COLUMN = "extraction_timestamp"

# Upsert key of the hourly log table.
CUT2_MERGE_KEYS = ("cap_id", "lite_id", "time", "event_seq")

# Scan counter width: positions wrap at 4096 (12-bit counter).
ROLLOVER_MODULUS = 4096

# Ingest reads the previous hour's file too during the first 10 minutes of an hour.
TRANSITION_WINDOW_MINUTES = 10

# Audit texts.
IDS_TEXT_LIMIT = 2000
NOTE_LIMIT = 1000
RUN_MESSAGE_LIMIT = 500
SAMPLE_SIZE = 20
TRUNCATION_SUFFIX = "...(truncated)"
NOTE_OK = "Audit passed with no divergences."
NOTE_NO_LOG = "No log files found for this audit date."
NOTE_NO_LOG_CUT2 = "No CUT2 log files found for this audit date."
KEY_LABEL_PLATE = "GrpID"
KEY_LABEL_COMPOSITE = "CompositeKey(Cap|Lite|Time|Seq)"

# Archive: the quarter is picked 15 days back from the run date.
ARCHIVE_LOOKBACK_DAYS = 15
ARCHIVE_CODEC = "snappy"

# Path and label formats.
HOURLY_PATH_REGEX = r"(\d{4})/(\d{2})/(\d{2})/(\d{2})\.csv$"
PLATE_PATH_REGEX = r"(\d{4})-(\d{2})/(\d{4}-\d{2}-\d{2})-PlateLog\.txt$"
WATERMARK_KEY_PREFIX = "watermark_cut2_"      # + yyyyMMdd_HH
ARCHIVE_PERIOD_SEPARATOR = "_a_"              # {start}_a_{end}

# Statuses.
STATUS_OK = "ok"
STATUS_MISSING = "missing_in_db"
STATUS_EXCESS = "excess_in_db"
STATUS_NO_LOG = "no_log"
STATUS_ERROR = "error"
STATUS_NO_RESULT = "no_result"

# ---------------------------------------------------------------------------
# Derived schema
# ---------------------------------------------------------------------------

MEASUREMENT_COLUMNS = tuple(
    c for c in CUT2_COLUMNS
    if c not in ("time",) + ID_COLUMNS + COMPUTED_COLUMNS + TEXT_COLUMNS
)
REQUIRED_FILE_COLUMNS = tuple(c for c in CUT2_COLUMNS if c not in COMPUTED_COLUMNS)


def _type_of(name: str) -> T.DataType:
    if name == "time":
        return T.TimestampNTZType()
    if name in ID_COLUMNS or name in COMPUTED_COLUMNS:
        return T.LongType()
    if name in TEXT_COLUMNS:
        return T.StringType()
    return T.DoubleType()


CUT2_SCHEMA = T.StructType(
    [T.StructField(c, _type_of(c), nullable=(c != "event_seq")) for c in CUT2_COLUMNS]
    + [T.StructField(EXTRACTION_COLUMN, T.TimestampNTZType(), True)]
)


@dataclass(frozen=True)
class LineSpec:
    """How one inspection line writes its log and where its table lives.

    kind: 'plate'  -> daily tab-separated plate log keyed by one ID column
          'hourly' -> hourly ';' log keyed by (cap, lite, time-of-day, event_seq)
    """

    name: str
    kind: str
    table: str
    log_key: str
    db_key: str
    log_date_col: str
    db_date_col: str
    sep: str
    key_label: str
    no_log_note: str = NOTE_NO_LOG
    date_sep: str = "/"          # between the parts of a date in the log's date column


LINES = {
    "MIRROR1": LineSpec("MIRROR1", "plate", "inspection_data_eagle_mirror1", "GrpID", "grpid",
                        "Date", "date", "\t", KEY_LABEL_PLATE),
    "CUT1": LineSpec("CUT1", "plate", "inspection_data_eagle_cut1", "GrpID", "grpid",
                     "Date", "date", "\t", KEY_LABEL_PLATE),
    "CUT2": LineSpec("CUT2", "hourly", "inspection_data_cut2", "lite_id", "lite_id",
                     "time", "time", ";", KEY_LABEL_COMPOSITE, NOTE_NO_LOG_CUT2),
}

# Archived / partitioned tables and their event-time column (case preserved).
ARCHIVE_TABLES = {
    "inspection_data_eagle_mirror1": "date",
    "inspection_data_eagle_cut1": "date",
    "inspection_data_cut2": "time",
    "p2_mirror2_defects": "Time",
    "p2_mirror2_panel": "starttime",
}
