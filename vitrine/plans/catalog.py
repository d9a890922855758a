"""Query catalog: every operator as a Spark query over the driver tables, each paired
with an independent DuckDB statement that must return the same rows.

Stand-ins (the driver tables are not machine logs, so they play these roles):
  events   -> plate log of line MIRROR1 (GrpID = event_id, Date = ts) and hourly log of
              line CUT2 (Lite id = user_id, Cap id = floor(value), Time = ts, one file per
              hour, physical position = event_id)
  lineitem -> plate log of line CUT1 (GrpID = l_orderkey, Date = l_shipdate); also an
              hourly log for the cleaning and ingest queries
  orders   -> table of line CUT1 (grpid = o_orderkey, date = o_orderdate); also the
              upsert target and the archived table
Every query reads whole tables; differences between log and table come from the data
itself (orders vs shipments, and the optional zero-ID rule on the CUT2 load).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.calendar import (hour_start, next_day_start, partition_label,
                                        period_label, quarter_end, quarter_start,
                                        transition_hours, watermark_key)
from vitrine.functions.clean import (bounded_text, canonical_id, composite_key, event_time,
                                     log_time, null_markers, py_list_text, scan_position,
                                     time_of_day, to_bigint, to_category, to_double)
from vitrine.operators import archive as arch
from vitrine.operators import reconcile as rc
from vitrine.operators.merge import conform, insert_ignore, upsert
from vitrine.operators.sequence import last_write_wins, with_event_seq
from vitrine.operators.watermark import file_changes
from vitrine.plans import transform as tf
from vitrine.plans import job_queries
from vitrine.session import fresh_dir
from vitrine.sources.fs import stored_bytes
from vitrine.spec import (CUT2_SCHEMA, KEY_LABEL_COMPOSITE, KEY_LABEL_PLATE,
                          NOTE_NO_LOG, NOTE_NO_LOG_CUT2)

# Parameters of the catalog (dates are the feature being tested, not a sample).
AUDITED_DAY = "2024-01-15"
WATERMARK_RUN = "2024-01-15 12:05:00"
ARCHIVE_AS_OF = "2000-04-10"
EXISTING_BEFORE = "2000-01-01"
STAGED_FROM = "1999-07-01"
SPLIT_ROWS = 8  # rows per simulated file split of the events stand-in
RUN_TS = "2024-02-01 00:00:00"
PART_BYTES = 2 << 20  # Parquet bytes of the audited tables whose keys are aggregated, or rows counted, by one task
PART_ROWS = 100_000  # and their rows: about as many as 2 MB of sf0.1, however well a table compresses

# The oracle's own copy of the fixed invalid markers.
MARKER_SQL = "'-1.#J', '1.#J', 'NaN', '1.#QNAN', '-1.#IND', '-1.#INF', '1.#INF'"
G_DOUBLE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
G_BIGINT = r"^[+-]?[0-9]+$"
G_TIME = r"^[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# Stand-in logs and tables (Spark)
# ---------------------------------------------------------------------------

def mirror1_log(ev: DataFrame) -> DataFrame:
    """Plate-log text rows; ``computed`` makes the text once per row, like file content."""
    return tf.computed(ev, [F.lit("MIRROR1").alias("line")],
                       Date=F.date_format("ts", "yyyy/MM/dd HH:mm:ss.SSSSSS"),
                       GrpID=F.col("event_id").cast("string"))


def cut1_log(li: DataFrame) -> DataFrame:
    oid = F.col("l_orderkey").cast("string")
    grp = F.when(F.col("l_returnflag") == "R", F.concat(oid, F.lit(".0"))) \
        .otherwise(F.concat(F.lit(" "), oid))
    return tf.computed(li, [F.lit("CUT1").alias("line")],
                       Date=F.date_format("l_shipdate", "yyyy/MM/dd HH:mm:ss"), GrpID=grp)


def cut2_raw(ev: DataFrame) -> DataFrame:
    """Events as hourly ';' log rows (text fields + file metadata)."""
    return tf.computed(
        ev, [F.lit("CUT2").alias("line")],
        file_key=watermark_key(hour_start("ts")),
        file_date=F.to_date("ts"),
        file_hour=hour_start("ts"),
        load_order=F.lit(0),
        block_start=F.floor(F.col("event_id") / SPLIT_ROWS).cast("bigint"),
        row_pos=F.col("event_id"),
        time=F.date_format("ts", "HH:mm:ss"),
        lite_id=F.col("user_id").cast("string"),
        cap_id=F.floor("value").cast("bigint").cast("string"),
        position=F.format_string("%.2f", "value"),
        total_result=F.col("event_type"),
    )


def cut2_table(ev: DataFrame, zero_rule: bool, parts: int | None = None) -> DataFrame:
    rows = tf.clean_hourly(cut2_raw(ev), RUN_TS, require_all=False)
    rows = tf.sequence_hourly(rows, parts=parts)
    return tf.zero_id_rule(rows, enabled=zero_rule)


def _audit_sides(spark, d, cut2_zero_rule=True, parts=None):
    """Log keys by line, and table rows by line; ``parts``: tasks of the CUT2 counters."""
    ev, li, od = _t(spark, d, "events"), _t(spark, d, "lineitem"), _t(spark, d, "orders")
    log_keys = [tf.plate_log_keys(mirror1_log(ev)), tf.plate_log_keys(cut1_log(li)),
                tf.hourly_log_keys(cut2_raw(ev), parts=parts)]
    table_rows = [tf.plate_table_rows(ev, "MIRROR1", "ts", "event_id"),
                  tf.plate_table_rows(od, "CUT1", "o_orderdate", "o_orderkey"),
                  tf.hourly_table_rows(cut2_table(ev, cut2_zero_rule, parts), "CUT2")]
    return log_keys, table_rows


def _audit_inputs(spark, d, cut2_zero_rule=True):
    log_keys, table_rows = _audit_sides(spark, d, cut2_zero_rule, _parts(spark, d, ("events",)))
    return reduce(DataFrame.unionByName, log_keys), reduce(DataFrame.unionByName, table_rows)


def _labels(spark):
    return spark.createDataFrame(
        [("MIRROR1", KEY_LABEL_PLATE, NOTE_NO_LOG), ("CUT1", KEY_LABEL_PLATE, NOTE_NO_LOG),
         ("CUT2", KEY_LABEL_COMPOSITE, NOTE_NO_LOG_CUT2)],
        "line string, key_label string, no_log_note string")


def _parts(spark, d, names=("events", "lineitem", "orders")):
    """Tasks of the key aggregation and of the counters: the session's, or more for larger tables,
    by bytes and by rows (counted from the files' footers). Not above the threshold up to which
    Spark writes a shuffle row by row: beyond it, a map task holds the rows of its whole file split."""
    size = sum(stored_bytes(spark, f"{d.rstrip('/')}/{n}.parquet") for n in names)
    rows = sum(_t(spark, d, n).count() for n in names)
    most = int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(most, max(-(-size // PART_BYTES), -(-rows // PART_ROWS))))


def _pairs(spark, d):
    lk, tr = _audit_inputs(spark, d)
    return rc.key_pairs(lk, tr, _parts(spark, d))


def _results(spark, d, cut2_zero_rule=True):
    lk, tr = _audit_inputs(spark, d, cut2_zero_rule)
    return rc.audit_results(lk, tr, _labels(spark).select("line", "key_label"), parts=_parts(spark, d))


# ---------------------------------------------------------------------------
# Spark queries
# ---------------------------------------------------------------------------

def q_scan_position(spark, d):
    li = _t(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").alias("lite_id"), F.col("l_partkey").alias("cap_id"),
                     "l_linenumber", scan_position("l_partkey", "l_orderkey").alias("scan_position"))


def _marker_text():
    m = F.col("l_linenumber")
    marker = F.element_at(F.array(*[F.lit(x) for x in
                                    ["-1.#J", " 1.#J", "NaN ", "1.#QNAN", "-1.#IND", "-1.#INF",
                                     "1.#INF"]]), m)
    measure = F.when(F.col("l_returnflag") == "R", marker) \
        .when(F.col("l_returnflag") == "A",
              F.concat(F.lit("  "), F.col("l_partkey").cast("string"), F.lit(".5 "))) \
        .otherwise(F.lit(""))
    result = F.when(F.col("l_linestatus") == "O", F.lit(" OK ")) \
        .when(F.col("l_linenumber") <= 3, marker).otherwise(F.lit("X"))
    return measure, result


def q_clean_markers(spark, d):
    measure, result = _marker_text()
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", measure.alias("m"),
                                         result.alias("tr"))
    return li.select("l_orderkey", "l_linenumber", null_markers("m").alias("measure_text"),
                     to_double("m").alias("measure"), to_category("tr").alias("total_result"))


def _number_text(ev):
    k = F.regexp_extract("props", r"([0-9]+)", 1)
    raw = F.when(F.col("event_type") == "click", F.concat(k, F.lit(".5"))) \
        .when(F.col("event_type") == "view", F.concat(F.lit("."), k)) \
        .when(F.col("event_type") == "error", F.concat(k, F.lit("e1"))) \
        .when(F.col("event_type") == "signup", F.concat(F.lit("00"), k)) \
        .otherwise(F.concat(F.lit(" +"), k, F.lit(" ")))
    junk = F.when(F.col("value") > 90, F.concat(k, F.lit("d"))) \
        .when(F.col("value") < 1, F.lit("0x1p3")).otherwise(F.concat(k, F.lit(",5")))
    return ev.select("event_id", raw.alias("raw"), junk.alias("junk"))


def q_coerce_double(spark, d):
    t = _number_text(_t(spark, d, "events"))
    return t.select("event_id", "raw", to_double("raw").alias("as_double"),
                    to_double("junk").alias("junk_double"))


def q_coerce_bigint(spark, d):
    t = _number_text(_t(spark, d, "events"))
    return t.select("event_id", "raw", to_bigint("raw").alias("as_bigint"),
                    to_bigint("junk").alias("junk_bigint"))


def q_event_time(spark, d):
    ev = _t(spark, d, "events")
    tt = F.when(F.col("event_type") == "click", F.date_format("ts", "HH:mm:ss")) \
        .when(F.col("event_type") == "view", F.date_format("ts", "H:mm:ss")) \
        .when(F.col("event_type") == "error", F.date_format("ts", "HH:mm:ss.SSS")) \
        .when(F.col("event_type") == "signup", F.lit("bad")).otherwise(F.lit(""))
    x = ev.select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("file_date"),
                  tt.alias("time_text"))
    fmt = "yyyy-MM-dd HH:mm:ss"
    return x.select("event_id", "time_text",
                    F.date_format(event_time("file_date", "time_text"), fmt).alias("etl_time"),
                    F.date_format(log_time("time_text", date_col=F.col("file_date")), fmt)
                    .alias("audit_time"))


def _grp_text():
    u = F.col("user_id").cast("string")
    return F.when(F.col("event_type") == "click", F.concat(u, F.lit(".0"))) \
        .when(F.col("event_type") == "view", F.concat(F.lit(" "), u, F.lit(" "))) \
        .when(F.col("event_type") == "error", F.concat(u, F.lit(".75"))).otherwise(u)


def q_canonical_id(spark, d):
    ev = _t(spark, d, "events").select("event_id", _grp_text().alias("raw"))
    return ev.select("event_id", "raw", canonical_id("raw").alias("canonical"),
                     to_bigint(canonical_id("raw")).alias("typed"))


def q_composite_key(spark, d):
    ev = _t(spark, d, "events").select(
        "event_id", "ts", F.to_date("ts").alias("day"),
        F.floor("value").cast("bigint").alias("cap"), F.col("user_id").alias("lite"),
        time_of_day("ts").alias("tod"),
        F.floor(F.col("event_id") / SPLIT_ROWS).cast("bigint").alias("block_start"))
    s = with_event_seq(ev, ["cap", "lite", "tod"], ["block_start", "event_id"], scope_cols=["day"],
                       split_col="block_start", parts=_parts(spark, d, ("events",)))
    return s.select("event_id", "tod", composite_key("cap", "lite", "ts", "event_seq").alias("key"))


def q_event_seq(spark, d):
    ev = _t(spark, d, "events").select(
        "event_id", "user_id", "event_type", hour_start("ts").alias("file_hour"),
        F.floor(F.col("event_id") / SPLIT_ROWS).cast("bigint").alias("block_start"))
    s = with_event_seq(ev, ["user_id", "event_type"], ["block_start", "event_id"],
                       scope_cols=["file_hour"], split_col="block_start", parts=_parts(spark, d, ("events",)))
    return s.select("event_id", "event_seq")


def q_event_seq_day(spark, d):
    ev = _t(spark, d, "events").select(
        "event_id", "user_id", "event_type", F.to_date("ts").alias("day"),
        hour_start("ts").alias("file_hour"))
    s = with_event_seq(ev, ["user_id", "event_type"], ["file_hour", "event_id"],
                       scope_cols=["day"], split_col="file_hour", parts=_parts(spark, d, ("events",)))
    return s.select("event_id", "event_seq")


def q_last_write_wins(spark, d):
    ev = _t(spark, d, "events").select("event_id", "user_id", "event_type",
                                       F.to_date("ts").alias("day"), "value")
    return last_write_wins(ev, ["user_id", "event_type", "day"], [F.col("event_id").desc()])


def q_quarter_range(spark, d):
    days = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return days.select("as_of", quarter_start(F.col("as_of")).alias("q_start"),
                       quarter_end(F.col("as_of")).alias("q_end"),
                       period_label(quarter_start(F.col("as_of")), quarter_end(F.col("as_of")))
                       .alias("period"))


def q_partition_bounds(spark, d):
    days = _t(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    fmt = "yyyy-MM-dd HH:mm:ss"
    return days.select("day", F.date_format(F.col("day").cast("timestamp_ntz"), fmt).alias("lower"),
                       F.date_format(next_day_start("day"), fmt).alias("upper"),
                       partition_label("inspection_data_cut2", F.col("day")).alias("partition"),
                       partition_label("inspection_data_cut2", F.date_add("day", 1))
                       .alias("next_partition"))


def q_transition_window(spark, d):
    ev = _t(spark, d, "events")
    x = ev.select("event_id", F.posexplode(transition_hours("ts")).alias("load_order", "h"))
    return x.select("event_id", F.col("load_order").cast("int").alias("load_order"),
                    watermark_key("h").alias("file_key"))


def q_day_scan(spark, d):
    ev = _t(spark, d, "events")
    return ev.where(F.to_date("ts") == F.lit(AUDITED_DAY).cast("date")) \
        .select("event_id", "user_id", "event_type")


def q_day_counts(spark, d):
    ev = _t(spark, d, "events")
    return ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("user_id").alias("distinct_ids"))


def q_late_rows_by_day(spark, d):
    """Plate-log files rotate 5 minutes before midnight: rows after 23:55 sit in the next
    day's file. Each file is read by two audits (its own day and the previous day)."""
    ev = _t(spark, d, "events").select(
        "ts", F.to_date(F.col("ts") + F.expr("INTERVAL 5 MINUTES")).alias("file_day"))
    reads = ev.select("ts", F.explode(F.array(
        F.struct(F.col("file_day").alias("audited_date"), F.lit(False).alias("from_next")),
        F.struct(F.date_sub("file_day", 1).alias("audited_date"), F.lit(True).alias("from_next")),
    )).alias("r")).select("ts", "r.*")
    kept = F.to_date("ts") == F.col("audited_date")
    return reads.groupBy("audited_date").agg(
        F.count_if(kept).cast("bigint").alias("rows_kept"),
        F.count_if(kept & F.col("from_next")).cast("bigint").alias("kept_from_next_file"),
        F.count_if(~kept).cast("bigint").alias("neighbours_dropped"))


def q_audit_keys(spark, d):
    lk, _ = _audit_inputs(spark, d)
    return lk


def q_zero_id_report(spark, d):
    ev = _t(spark, d, "events")
    return ev.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("user_id") == 0).cast("bigint").alias("zero_id_rows"))


def q_missing_in_db(spark, d):
    lk, tr = _audit_inputs(spark, d)
    return rc.only_left(lk, tr, _parts(spark, d))


def q_excess_in_db(spark, d):
    lk, tr = _audit_inputs(spark, d)
    return rc.only_left(tr, lk, _parts(spark, d))


def q_except_ids(spark, d):
    lk, tr = _audit_inputs(spark, d)
    return rc.except_keys(lk, tr)


def q_reconcile_ids(spark, d):
    return rc.reconcile_counts(_pairs(spark, d))


def q_audit_status(spark, d):
    return rc.classify(rc.reconcile_counts(_pairs(spark, d))) \
        .select("line", "audited_date", "total_log", "total_db", "divergence", "status")


def q_audit_note(spark, d):
    return _results(spark, d).select("line", "audited_date", "status", "note")


def q_missing_sample(spark, d):
    s = rc.ranked_keys(rc.missing_keys(_pairs(spark, d)), 20, _parts(spark, d))
    return s.select("line", "audited_date", py_list_text("keys").alias("sample"))


def q_missing_ids_text(spark, d):
    s = rc.ranked_keys(rc.missing_keys(_pairs(spark, d)), rc.IDS_TEXT_RANKS, _parts(spark, d))
    return s.select("line", "audited_date", bounded_text(F.array_join("keys", ",")).alias("ids_missing"))


def q_audit_all_lines(spark, d):
    return _results(spark, d).select(*rc.RESULT_COLUMNS)


def q_audit_summary(spark, d):
    res = rc.classify(rc.reconcile_counts(_pairs(spark, d)))  # statuses need no ID texts
    days = rc.audited_days(*_audit_sides(spark, d))
    expected = rc.expected_lines(days, ["MIRROR1", "CUT1", "CUT2"])
    return rc.audit_summary(res, expected)


def q_audit_rerun(spark, d):
    """First run: CUT2 table loaded with the zero-ID rule (rows missing). Re-run after a
    full reload: CUT2 only. Upsert by (line, audited_date) keeps the other lines."""
    first = _results(spark, d, cut2_zero_rule=True).select(*rc.RESULT_COLUMNS)
    ev, parts = _t(spark, d, "events"), _parts(spark, d, ("events",))
    rerun = rc.audit_results(tf.hourly_log_keys(cut2_raw(ev), parts=parts),
                             tf.hourly_table_rows(cut2_table(ev, False, parts), "CUT2"),
                             _labels(spark).select("line", "key_label"), parts=parts).select(*rc.RESULT_COLUMNS)
    path = fresh_dir(spark, "audit_rerun")
    rerun.write.parquet(path)  # one row a day; the upsert reads its staged rows twice
    rerun = spark.read.schema(rerun.schema).parquet(path)
    return upsert(first, rerun, ["line", "audited_date"])


def _file_sizes(ev, upto=None):
    line_len = F.length(F.concat_ws(";", F.col("event_id").cast("string"),
                                    F.col("user_id").cast("string"), "event_type", "props")) + 1
    x = ev if upto is None else ev.where(F.col("ts") <= F.lit(upto).cast("timestamp_ntz"))
    return x.groupBy(watermark_key(hour_start("ts")).alias("file_key")) \
        .agg(F.sum(line_len).cast("bigint").alias("size"))


def q_file_changes(spark, d):
    ev = _t(spark, d, "events")
    listing = _file_sizes(ev)
    wm = _file_sizes(ev, WATERMARK_RUN)
    return file_changes(listing, wm).select("file_key", "size", "prev_size", "action")


def _order_rows(od):
    return od.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     F.to_date("o_orderdate").alias("order_day"), "o_orderpriority")


def _upsert_inputs(spark, d):
    od = _order_rows(_t(spark, d, "orders"))
    existing = od.where(F.col("order_day") < F.lit(EXISTING_BEFORE).cast("date")) \
        .withColumn("loaded_from", F.lit("existing"))
    staged = od.where(F.col("order_day") >= F.lit(STAGED_FROM).cast("date")) \
        .withColumn("o_totalprice", F.col("o_totalprice") + F.lit(100.0)) \
        .withColumn("loaded_from", F.lit("staged"))
    return existing, staged


def q_upsert_update(spark, d):
    existing, staged = _upsert_inputs(spark, d)
    return upsert(existing, staged, ["o_orderkey"])


def q_upsert_ignore(spark, d):
    existing, staged = _upsert_inputs(spark, d)
    return insert_ignore(existing, staged, ["o_orderkey"])


def q_upsert_replay(spark, d):
    existing, staged = _upsert_inputs(spark, d)
    once = upsert(existing, staged, ["o_orderkey"])
    return upsert(once, staged, ["o_orderkey"])


def lineitem_raw(li: DataFrame) -> DataFrame:
    """lineitem as hourly-log text rows; one 'file' per ship month."""
    measure, result = _marker_text()
    return li.select(
        F.date_format("l_shipdate", "yyyy/MM").alias("file_key"),
        F.to_date("l_shipdate").alias("file_date"),
        F.lit(0).alias("load_order"),
        F.lit(0).cast("bigint").alias("block_start"),
        F.monotonically_increasing_id().alias("row_pos"),
        F.date_format("l_shipdate", "HH:mm:ss").alias("time"),
        F.col("l_orderkey").cast("string").alias("lite_id"),
        F.col("l_partkey").cast("string").alias("cap_id"),
        F.col("l_suppkey").cast("string").alias("convoy_id"),
        F.col("l_linenumber").cast("string").alias("tolerance_nbr"),
        measure.alias("length_diff"),
        result.alias("total_result"))


def q_ingest_result(spark, d):
    rows = tf.clean_hourly(lineitem_raw(_t(spark, d, "lineitem")), RUN_TS, require_all=False)
    staged = conform(rows.withColumn("event_seq", F.lit(0)), CUT2_SCHEMA, extra=[F.col("file_key")])
    return staged.groupBy("file_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("scan_position").alias("rows_with_position"),
        F.count("length_diff").alias("rows_with_length_diff"),
        F.count("total_result").alias("rows_with_result"))


def _archive_table(spark, d):
    od = _t(spark, d, "orders")
    return od.select("o_orderkey", F.to_date("o_orderdate").alias("event_date"))


def q_archive_scan(spark, d):
    s, e = arch.quarter_range(ARCHIVE_AS_OF)
    return arch.archive_scan(_archive_table(spark, d), s, e)


def _stream(name):
    def run(spark, d):
        from vitrine.streaming import catalog_streams
        return getattr(catalog_streams, name)(spark, d)
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_position": q_scan_position,
    "clean_markers": q_clean_markers,
    "coerce_double": q_coerce_double,
    "coerce_bigint": q_coerce_bigint,
    "event_time": q_event_time,
    "canonical_id": q_canonical_id,
    "composite_key": q_composite_key,
    "event_seq": q_event_seq,
    "event_seq_day": q_event_seq_day,
    "last_write_wins": q_last_write_wins,
    "quarter_range": q_quarter_range,
    "partition_bounds": q_partition_bounds,
    "transition_window": q_transition_window,
    "day_scan": q_day_scan,
    "day_counts": q_day_counts,
    "late_rows_by_day": q_late_rows_by_day,
    "audit_keys": q_audit_keys,
    "zero_id_report": q_zero_id_report,
    "missing_in_db": q_missing_in_db,
    "excess_in_db": q_excess_in_db,
    "except_ids": q_except_ids,
    "reconcile_ids": q_reconcile_ids,
    "audit_status": q_audit_status,
    "audit_note": q_audit_note,
    "missing_sample": q_missing_sample,
    "missing_ids_text": q_missing_ids_text,
    "audit_all_lines": q_audit_all_lines,
    "audit_summary": q_audit_summary,
    "audit_rerun": q_audit_rerun,
    "file_changes": q_file_changes,
    "upsert_update": q_upsert_update,
    "upsert_ignore": q_upsert_ignore,
    "upsert_replay": q_upsert_replay,
    "ingest_result": q_ingest_result,
    "archive_scan": q_archive_scan,
    "stream_ingest": _stream("stream_ingest"),
    "stream_dedup": _stream("stream_dedup"),
    "stream_day_counts": _stream("stream_day_counts"),
    "stream_late_rows": _stream("stream_late_rows"),
    "stream_late_kept": _stream("stream_late_kept"),
}


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------

def _s_clean(x):
    return f"CASE WHEN trim({x}) IN ({MARKER_SQL}) OR trim({x}) = '' THEN NULL ELSE trim({x}) END"


def _s_double(x):
    c = _s_clean(x)
    return f"CASE WHEN regexp_matches({c}, '{G_DOUBLE}') THEN TRY_CAST({c} AS DOUBLE) END"


def _s_bigint(x):
    c = _s_clean(x)
    return f"CASE WHEN regexp_matches({c}, '{G_BIGINT}') THEN TRY_CAST({c} AS BIGINT) END"


_S_MARKER = ("(['-1.#J', ' 1.#J', 'NaN ', '1.#QNAN', '-1.#IND', '-1.#INF', '1.#INF'])"
             "[l_linenumber]")
_S_MEASURE = (f"CASE WHEN l_returnflag = 'R' THEN {_S_MARKER} "
              "WHEN l_returnflag = 'A' THEN '  ' || CAST(l_partkey AS VARCHAR) || '.5 ' ELSE '' END")
_S_RESULT = (f"CASE WHEN l_linestatus = 'O' THEN ' OK ' WHEN l_linenumber <= 3 THEN {_S_MARKER} "
             "ELSE 'X' END")
_S_K = "regexp_extract(props, '([0-9]+)', 1)"
_S_RAW = (f"CASE event_type WHEN 'click' THEN {_S_K} || '.5' WHEN 'view' THEN '.' || {_S_K} "
          f"WHEN 'error' THEN {_S_K} || 'e1' WHEN 'signup' THEN '00' || {_S_K} "
          f"ELSE ' +' || {_S_K} || ' ' END")
_S_JUNK = (f"CASE WHEN value > 90 THEN {_S_K} || 'd' WHEN value < 1 THEN '0x1p3' "
           f"ELSE {_S_K} || ',5' END")

# Audit inputs written directly (no text round trip): the independent form.
_AUDIT_CTE = f"""
cut2_log AS (
  SELECT CAST(ts AS DATE) AS d, CAST(floor(value) AS BIGINT) AS cap, user_id AS lite,
         strftime(ts, '%H:%M:%S') AS t, event_id FROM events),
cut2_seq AS (
  SELECT d, cap, lite, t,
         row_number() OVER (PARTITION BY d, cap, lite, t ORDER BY event_id) - 1 AS seq
  FROM cut2_log),
log_keys AS (
  SELECT 'MIRROR1' AS line, CAST(ts AS DATE) AS audited_date, CAST(event_id AS VARCHAR) AS key
  FROM events
  UNION ALL
  SELECT 'CUT1', CAST(l_shipdate AS DATE), CAST(l_orderkey AS VARCHAR) FROM lineitem
  UNION ALL
  SELECT 'CUT2', d, CAST(cap AS VARCHAR) || '|' || CAST(lite AS VARCHAR) || '|' || t || '|'
         || CAST(seq AS VARCHAR) FROM cut2_seq),
table_rows AS (
  SELECT 'MIRROR1' AS line, CAST(ts AS DATE) AS audited_date, CAST(event_id AS VARCHAR) AS key
  FROM events
  UNION ALL
  SELECT 'CUT1', CAST(o_orderdate AS DATE), CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL
  SELECT 'CUT2', d, CAST(cap AS VARCHAR) || '|' || CAST(lite AS VARCHAR) || '|' || t || '|'
         || CAST(seq AS VARCHAR) FROM cut2_seq WHERE {{cut2_filter}}),
lk AS (SELECT DISTINCT line, audited_date, key FROM log_keys),
missing AS (SELECT line, audited_date, key FROM lk
            WHERE NOT EXISTS (SELECT 1 FROM table_rows t WHERE t.line = lk.line
                              AND t.audited_date = lk.audited_date AND t.key = lk.key)),
extra AS (SELECT DISTINCT line, audited_date, key FROM table_rows t
          WHERE key IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lk WHERE t.line = lk.line
                AND t.audited_date = lk.audited_date AND t.key = lk.key)),
days AS (SELECT line, audited_date FROM lk UNION SELECT line, audited_date FROM table_rows),
counts AS (
  SELECT g.line, g.audited_date,
    CAST((SELECT count(*) FROM lk WHERE lk.line = g.line AND lk.audited_date = g.audited_date) AS BIGINT) AS total_log,
    CAST((SELECT count(*) FROM table_rows t WHERE t.line = g.line AND t.audited_date = g.audited_date) AS BIGINT) AS total_db,
    CAST((SELECT count(DISTINCT key) FROM table_rows t WHERE t.line = g.line AND t.audited_date = g.audited_date) AS BIGINT) AS distinct_db,
    CAST((SELECT count(*) FROM missing m WHERE m.line = g.line AND m.audited_date = g.audited_date) AS BIGINT) AS n_missing,
    CAST((SELECT count(*) FROM extra x WHERE x.line = g.line AND x.audited_date = g.audited_date) AS BIGINT) AS n_extra
  FROM days g),
status AS (
  SELECT *, total_log - total_db AS divergence,
    CASE WHEN total_log - total_db = 0 AND n_missing = 0 AND n_extra = 0 THEN 'ok'
         WHEN total_log - total_db >= 0 THEN 'missing_in_db' ELSE 'excess_in_db' END AS status
  FROM counts),
miss_text AS (SELECT line, audited_date, string_agg(key, ',' ORDER BY key) AS s FROM missing
              GROUP BY line, audited_date),
miss_top AS (SELECT line, audited_date, key FROM (SELECT *, row_number() OVER
             (PARTITION BY line, audited_date ORDER BY key) AS r FROM missing) WHERE r <= 20),
extra_top AS (SELECT line, audited_date, key FROM (SELECT *, row_number() OVER
             (PARTITION BY line, audited_date ORDER BY key) AS r FROM extra) WHERE r <= 20),
miss_s AS (SELECT line, audited_date, '[' || string_agg('''' || key || '''', ', ' ORDER BY key)
           || ']' AS s FROM miss_top GROUP BY line, audited_date),
extra_s AS (SELECT line, audited_date, '[' || string_agg('''' || key || '''', ', ' ORDER BY key)
            || ']' AS s FROM extra_top GROUP BY line, audited_date),
results AS (
  SELECT st.line, st.audited_date, st.total_log, st.total_db, st.divergence,
    CASE WHEN st.status = 'ok' THEN '' WHEN length(coalesce(mt.s, '')) > 2000
         THEN substr(mt.s, 1, 2000) || '...(truncated)' ELSE coalesce(mt.s, '') END AS ids_missing,
    st.status,
    substr(CASE WHEN st.status = 'ok' THEN 'Audit passed with no divergences.'
      WHEN st.status = 'missing_in_db' THEN printf('Divergence of %d record(s). %d IDs in log missing from DB. %s sample: %s',
           st.divergence, st.n_missing, CASE WHEN st.line = 'CUT2' THEN '{KEY_LABEL_COMPOSITE}' ELSE '{KEY_LABEL_PLATE}' END,
           coalesce(ms.s, '[]'))
      ELSE printf('DB has %d extra record(s). %d IDs in DB absent from log. %s sample: %s',
           abs(st.divergence), st.n_extra, CASE WHEN st.line = 'CUT2' THEN '{KEY_LABEL_COMPOSITE}' ELSE '{KEY_LABEL_PLATE}' END,
           coalesce(xs.s, '[]')) END, 1, 1000) AS note
  FROM status st
  LEFT JOIN miss_text mt ON mt.line = st.line AND mt.audited_date = st.audited_date
  LEFT JOIN miss_s ms ON ms.line = st.line AND ms.audited_date = st.audited_date
  LEFT JOIN extra_s xs ON xs.line = st.line AND xs.audited_date = st.audited_date)
"""


def _audit_sql(select: str, zero_rule: bool = True) -> str:
    cte = _AUDIT_CTE.replace("{cut2_filter}", "lite <> 0" if zero_rule else "TRUE")
    return f"WITH {cte} {select}"


def _file_sizes_sql(upto=None):
    w = f"WHERE ts <= TIMESTAMP '{upto}'" if upto else ""
    return (f"SELECT 'watermark_cut2_' || strftime(ts, '%Y%m%d_%H') AS file_key, "
            f"CAST(sum(length(concat_ws(';', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), "
            f"event_type, props)) + 1) AS BIGINT) AS size FROM events {w} GROUP BY 1")


_UPSERT_CTE = f"""
od AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day,
              o_orderpriority FROM orders),
ex AS (SELECT *, 'existing' AS loaded_from FROM od WHERE order_day < DATE '{EXISTING_BEFORE}'),
st AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100.0 AS o_totalprice, order_day,
              o_orderpriority, 'staged' AS loaded_from FROM od WHERE order_day >= DATE '{STAGED_FROM}')
"""

_Q_S, _Q_E = "DATE '2000-01-01'", "DATE '2000-03-31'"  # quarter of ARCHIVE_AS_OF

# A row's piece, the newest row of all earlier pieces, and the bound that follows (whole
# milliseconds, ten minutes before it).
def _late_sql(select: str) -> str:
    return f"""
        WITH own AS (
          SELECT *, epoch_us(ts) AS us,
            CASE WHEN ts > TIMESTAMP '2024-01-23' THEN 3 WHEN ts > TIMESTAMP '2024-01-16' THEN 2
                 WHEN ts > TIMESTAMP '2024-01-08' THEN 1 ELSE 0 END AS piece FROM events),
        sent AS (
          SELECT * EXCLUDE piece, piece + CASE WHEN event_id % 3 = 0 AND (
              (ts > TIMESTAMP '2024-01-07 12:00:00' AND ts <= TIMESTAMP '2024-01-08')
              OR (ts > TIMESTAMP '2024-01-15 12:00:00' AND ts <= TIMESTAMP '2024-01-16')
              OR (ts > TIMESTAMP '2024-01-22 12:00:00' AND ts <= TIMESTAMP '2024-01-23')) THEN 1 ELSE 0 END AS piece FROM own),
        newest AS (SELECT p.piece, max(s.us) AS seen FROM (SELECT DISTINCT piece FROM sent) p JOIN sent s ON s.piece < p.piece GROUP BY p.piece),
        marked AS (SELECT sent.*, (seen // 1000 - 600000) * 1000 AS bound FROM sent LEFT JOIN newest USING (piece))
        {select}"""


ORACLE: dict[str, str] = {
    "scan_position": "SELECT l_orderkey AS lite_id, l_partkey AS cap_id, l_linenumber, "
                     "CAST((((l_partkey - l_orderkey) % 4096) + 4096) % 4096 AS BIGINT) AS scan_position "
                     "FROM lineitem",
    "clean_markers": f"SELECT l_orderkey, l_linenumber, {_s_clean('m')} AS measure_text, "
                     f"{_s_double('m')} AS measure, {_s_clean('tr')} AS total_result FROM "
                     f"(SELECT l_orderkey, l_linenumber, {_S_MEASURE} AS m, {_S_RESULT} AS tr FROM lineitem)",
    "coerce_double": f"SELECT event_id, raw, {_s_double('raw')} AS as_double, {_s_double('junk')} AS junk_double "
                     f"FROM (SELECT event_id, {_S_RAW} AS raw, {_S_JUNK} AS junk FROM events)",
    "coerce_bigint": f"SELECT event_id, raw, {_s_bigint('raw')} AS as_bigint, {_s_bigint('junk')} AS junk_bigint "
                     f"FROM (SELECT event_id, {_S_RAW} AS raw, {_S_JUNK} AS junk FROM events)",
    "event_time": f"""
        SELECT event_id, time_text,
          strftime(CASE WHEN regexp_matches(trim(time_text), '{G_TIME}')
                   THEN try_strptime(file_date || ' ' || trim(time_text), '%Y-%m-%d %H:%M:%S') END,
                   '%Y-%m-%d %H:%M:%S') AS etl_time,
          strftime(CASE WHEN regexp_matches(split_part(trim(time_text), '.', 1), '{G_TIME}')
                   THEN try_strptime(file_date || ' ' || split_part(trim(time_text), '.', 1), '%Y-%m-%d %H:%M:%S') END,
                   '%Y-%m-%d %H:%M:%S') AS audit_time
        FROM (SELECT event_id, strftime(ts, '%Y-%m-%d') AS file_date,
                CASE event_type WHEN 'click' THEN strftime(ts, '%H:%M:%S')
                  WHEN 'view' THEN strftime(ts, '%-H:%M:%S')
                  WHEN 'error' THEN strftime(ts, '%H:%M:%S.%g')
                  WHEN 'signup' THEN 'bad' ELSE '' END AS time_text FROM events)""",
    "canonical_id": """
        SELECT event_id, raw, trim(split_part(trim(raw), '.', 1)) AS canonical,
               TRY_CAST(trim(split_part(trim(raw), '.', 1)) AS BIGINT) AS typed
        FROM (SELECT event_id, CASE event_type WHEN 'click' THEN CAST(user_id AS VARCHAR) || '.0'
                WHEN 'view' THEN ' ' || CAST(user_id AS VARCHAR) || ' '
                WHEN 'error' THEN CAST(user_id AS VARCHAR) || '.75' ELSE CAST(user_id AS VARCHAR) END AS raw
              FROM events)""",
    "composite_key": """
        SELECT event_id, t AS tod, CAST(cap AS VARCHAR) || '|' || CAST(lite AS VARCHAR) || '|' || t || '|' ||
               CAST(row_number() OVER (PARTITION BY d, cap, lite, t ORDER BY event_id) - 1 AS VARCHAR) AS key
        FROM (SELECT event_id, CAST(ts AS DATE) AS d, CAST(floor(value) AS BIGINT) AS cap, user_id AS lite,
                     strftime(ts, '%H:%M:%S') AS t FROM events)""",
    "event_seq": "SELECT event_id, CAST(row_number() OVER (PARTITION BY date_trunc('hour', ts), user_id, "
                 "event_type ORDER BY event_id) - 1 AS BIGINT) AS event_seq FROM events",
    "event_seq_day": "SELECT event_id, CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE), user_id, "
                     "event_type ORDER BY date_trunc('hour', ts), event_id) - 1 AS BIGINT) AS event_seq FROM events",
    "last_write_wins": "SELECT event_id, user_id, event_type, day, value FROM (SELECT event_id, user_id, "
                       "event_type, CAST(ts AS DATE) AS day, value, row_number() OVER (PARTITION BY user_id, "
                       "event_type, CAST(ts AS DATE) ORDER BY event_id DESC) AS r FROM events) WHERE r = 1",
    "quarter_range": "SELECT as_of, q_start, q_end, CAST(q_start AS VARCHAR) || '_a_' || CAST(q_end AS VARCHAR) "
                     "AS period FROM (SELECT as_of, CAST(date_trunc('quarter', as_of - 15) AS DATE) AS q_start, "
                     "CAST(date_trunc('quarter', as_of - 15) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS q_end "
                     "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders))",
    "partition_bounds": "SELECT day, strftime(CAST(day AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS lower, "
                        "strftime(CAST(day + 1 AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS upper, "
                        "'inspection_data_cut2_' || strftime(day, '%Y_%m_%d') AS partition, "
                        "'inspection_data_cut2_' || strftime(day + 1, '%Y_%m_%d') AS next_partition "
                        "FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)",
    "transition_window": "SELECT event_id, 0 AS load_order, 'watermark_cut2_' || strftime(ts, '%Y%m%d_%H') "
                         "AS file_key FROM events UNION ALL SELECT event_id, 1, 'watermark_cut2_' || "
                         "strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR, '%Y%m%d_%H') FROM events "
                         "WHERE minute(ts) < 10",
    "day_scan": f"SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '{AUDITED_DAY}'",
    "day_counts": "SELECT CAST(ts AS DATE) AS day, count(*) AS rows, count(DISTINCT user_id) AS distinct_ids "
                  "FROM events GROUP BY 1",
    "late_rows_by_day": """
        WITH f AS (SELECT CAST(ts AS DATE) AS d, CAST(ts + INTERVAL 5 MINUTE AS DATE) AS file_day FROM events),
        r AS (SELECT d, file_day AS audited_date, false AS from_next FROM f
              UNION ALL SELECT d, CAST(file_day - 1 AS DATE), true FROM f)
        SELECT audited_date, CAST(count(*) FILTER (WHERE d = audited_date) AS BIGINT) AS rows_kept,
               CAST(count(*) FILTER (WHERE d = audited_date AND from_next) AS BIGINT) AS kept_from_next_file,
               CAST(count(*) FILTER (WHERE d <> audited_date) AS BIGINT) AS neighbours_dropped
        FROM r GROUP BY audited_date""",
    "audit_keys": _audit_sql("SELECT line, audited_date, key FROM log_keys"),
    "zero_id_report": "SELECT CAST(ts AS DATE) AS day, count(*) AS rows, "
                      "CAST(count(*) FILTER (WHERE user_id = 0) AS BIGINT) AS zero_id_rows FROM events GROUP BY 1",
    "missing_in_db": _audit_sql("SELECT line, audited_date, key FROM missing"),
    "excess_in_db": _audit_sql("SELECT line, audited_date, key FROM extra"),
    "except_ids": _audit_sql("SELECT line, audited_date, key FROM log_keys EXCEPT "
                             "SELECT line, audited_date, key FROM table_rows"),
    "reconcile_ids": _audit_sql("SELECT line, audited_date, total_log, total_db, distinct_db, n_missing, "
                                "n_extra, total_log - total_db AS divergence FROM counts"),
    "audit_status": _audit_sql("SELECT line, audited_date, total_log, total_db, divergence, status FROM status"),
    "audit_note": _audit_sql("SELECT line, audited_date, status, note FROM results"),
    "missing_sample": _audit_sql("SELECT line, audited_date, s AS sample FROM miss_s"),
    "missing_ids_text": _audit_sql("SELECT line, audited_date, CASE WHEN length(s) > 2000 THEN "
                                   "substr(s, 1, 2000) || '...(truncated)' ELSE s END AS ids_missing FROM miss_text"),
    "audit_all_lines": _audit_sql("SELECT line, audited_date, total_log, total_db, divergence, ids_missing, "
                                  "status, note FROM results"),
    "audit_summary": _audit_sql("""
        , dd AS (SELECT DISTINCT audited_date FROM results),
        grid AS (SELECT l.line, dd.audited_date FROM dd, (VALUES ('MIRROR1'), ('CUT1'), ('CUT2')) l(line)),
        s AS (SELECT g.line, g.audited_date, r.total_log, r.total_db, r.divergence,
                     coalesce(r.status, 'no_result') AS status
              FROM grid g LEFT JOIN results r ON r.line = g.line AND r.audited_date = g.audited_date)
        SELECT *, max(CASE WHEN status <> 'ok' THEN 1 ELSE 0 END) OVER (PARTITION BY audited_date) = 1
               AS day_failed FROM s"""),
    "audit_rerun": "SELECT * FROM (" + _audit_sql(
        "SELECT line, audited_date, total_log, total_db, divergence, ids_missing, status, note "
        "FROM results WHERE line <> 'CUT2'") + ") UNION ALL SELECT * FROM (" + _audit_sql(
        "SELECT line, audited_date, total_log, total_db, divergence, ids_missing, status, note "
        "FROM results WHERE line = 'CUT2'", zero_rule=False) + ")",
    "file_changes": f"""
        WITH cur AS ({_file_sizes_sql()}), wm AS ({_file_sizes_sql(WATERMARK_RUN)})
        SELECT cur.file_key, cur.size, CAST(coalesce(wm.size, 0) AS BIGINT) AS prev_size,
          CASE WHEN cur.size = coalesce(wm.size, 0) THEN 'unchanged'
               WHEN cur.size > coalesce(wm.size, 0) THEN 'updated' ELSE 'recreated' END AS action
        FROM cur LEFT JOIN wm ON cur.file_key = wm.file_key""",
    "upsert_update": f"WITH {_UPSERT_CTE} SELECT * FROM st UNION ALL SELECT * FROM ex "
                     "WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.o_orderkey IS NOT DISTINCT FROM ex.o_orderkey)",
    "upsert_ignore": f"WITH {_UPSERT_CTE} SELECT * FROM ex UNION ALL SELECT * FROM st "
                     "WHERE NOT EXISTS (SELECT 1 FROM ex WHERE st.o_orderkey IS NOT DISTINCT FROM ex.o_orderkey)",
    "upsert_replay": f"WITH {_UPSERT_CTE} SELECT * FROM st UNION ALL SELECT * FROM ex "
                     "WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.o_orderkey IS NOT DISTINCT FROM ex.o_orderkey)",
    "ingest_result": f"""
        SELECT strftime(l_shipdate, '%Y/%m') AS file_key, count(*) AS rows,
               count(*) AS rows_with_position,
               count({_s_double('m')}) AS rows_with_length_diff,
               count({_s_clean('tr')}) AS rows_with_result
        FROM (SELECT l_shipdate, {_S_MEASURE} AS m, {_S_RESULT} AS tr FROM lineitem) GROUP BY 1""",
    "archive_scan": f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date FROM orders "
                    f"WHERE CAST(o_orderdate AS DATE) BETWEEN {_Q_S} AND {_Q_E}",
    "stream_ingest": "SELECT event_id, user_id, event_type, CAST(row_number() OVER (PARTITION BY "
                     "date_trunc('hour', ts), user_id, event_type ORDER BY event_id) - 1 AS BIGINT) AS event_seq "
                     "FROM events",
    "stream_dedup": "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d %H') AS hour_key FROM events",
    "stream_day_counts": "SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1",
    "stream_late_rows": _late_sql("SELECT event_id, user_id, event_type, CAST(bound - us AS BIGINT) AS late_by_us FROM marked WHERE us <= bound"),
    "stream_late_kept": _late_sql("SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d %H') AS hour_key FROM marked WHERE bound IS NULL OR us > bound"),
}


QUERIES |= job_queries.QUERIES
ORACLE |= job_queries.ORACLE


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
