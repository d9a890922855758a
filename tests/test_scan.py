from pyspark.sql import functions as F

from tests.fixtures import HEADER, row, write_hourly
from vitrine.plans import transform as tf
from vitrine.sources.listing import list_hourly_logs, select_ingest_files
from vitrine.sources.logscan import read_log
from vitrine.spec import REQUIRED_FILE_COLUMNS


def _read(spark, paths, **kw):
    return read_log(spark, paths, ";", REQUIRED_FILE_COLUMNS, kind="hourly", **kw)


def test_header_mapping_reordered_and_extra(spark, tmp):
    a = write_hourly(tmp, "2024-01-05", 7, [row(lite="1", cap="2", measure="1.5")])
    hdr = list(reversed(HEADER)) + ["Firmware Note"]
    b = write_hourly(tmp, "2024-01-05", 8, [row(lite="3", cap="4", measure="2.5", firmware_note="zz")],
                     header=hdr)
    r = _read(spark, [a, b])
    got = {(x["lite_id"], x["cap_id"], x["nominal_length"], x["file_key"]) for x in r.rows.collect()}
    assert got == {("1", "2", "1.5", "watermark_cut2_20240105_07"),
                   ("3", "4", "2.5", "watermark_cut2_20240105_08")}
    assert r.rejected.count() == 0


def test_missing_and_duplicate_columns_rejected(spark, tmp):
    miss = write_hourly(tmp, "2024-01-05", 1, [row()], header=HEADER[:-1])
    dup = write_hourly(tmp, "2024-01-05", 2, [row()], header=HEADER + ["CAP ID"])
    good = write_hourly(tmp, "2024-01-05", 3, [row(lite="9")])
    r = _read(spark, [miss, dup, good])
    reasons = {x["path"].split("/")[-1]: x["reason"] for x in r.rejected.collect()}
    assert reasons["01.csv"].startswith("Missing columns") and "lft_dev" in reasons["01.csv"]
    assert reasons["02.csv"].startswith("Duplicate columns")
    assert [x["lite_id"] for x in r.rows.collect()] == ["9"]


def test_ragged_and_bad_utf8_fail_the_file(spark, tmp):
    short = write_hourly(tmp, "2024-01-05", 4, [row()], raw_lines=["07:00:00;1;2"])
    long = write_hourly(tmp, "2024-01-05", 5, [row()], raw_lines=[";".join(["1"] * (len(HEADER) + 1))])
    bad = write_hourly(tmp, "2024-01-05", 6, [row()], encoding_bytes=b"07:00:00;\xc3\x28" + b";1" * (len(HEADER) - 2) + b"\n")
    ok = write_hourly(tmp, "2024-01-05", 7, [row(lite="5")])
    r = _read(spark, [short, long, bad, ok])
    assert {x["path"].split("/")[-1] for x in r.rejected.collect()} == {"04.csv", "05.csv", "06.csv"}
    assert [x["lite_id"] for x in r.rows.collect()] == ["5"]
    q = _read(spark, [short, ok], on_corrupt="quarantine")
    assert sorted(x["lite_id"] for x in q.rows.collect()) == ["12", "5"]
    assert q.corrupt.count() == 1


def test_event_seq_same_for_many_splits(spark, tmp):
    rows = []
    for i in range(3000):
        rows.append(row(time=f"07:{(i // 40) % 60:02d}:00", lite=str(i % 3), cap="1", measure=str(i)))
    p = write_hourly(tmp, "2024-01-05", 7, rows)
    results = []
    for max_bytes, open_cost in (("134217728", "134217728"), ("20000", "1000")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", max_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", open_cost)
        try:
            r = _read(spark, [p])
            splits = r.rows.select("block_start").distinct().count()
            typed = tf.clean_hourly(r.rows.withColumn("load_order", F.lit(0)), "2024-02-01 00:00:00")
            seq = tf.sequence_hourly(typed)
            results.append((splits, {(x["convoy_id"], x["event_seq"]) for x in seq.collect()}))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    assert results[0][0] == 1 and results[1][0] > 5
    assert results[0][1] == results[1][1]
    # each (cap, lite, time) group of 40//3 rows is numbered densely in file order
    expected = {}
    counters = {}
    for i in range(3000):
        g = (f"07:{(i // 40) % 60:02d}:00", i % 3)
        expected[float(i)] = counters.get(g, 0)
        counters[g] = expected[float(i)] + 1
    assert {k: v for k, v in results[1][1]} == expected


def test_listing_and_transition_selection(spark, tmp):
    for h in (8, 9, 10):
        write_hourly(tmp, "2024-01-05", h, [row()])
    lst = list_hourly_logs(spark, tmp)
    early = select_ingest_files(lst, "2024-01-05 10:05:00").orderBy("load_order").collect()
    assert [(r["file_key"], r["load_order"]) for r in early] == [
        ("watermark_cut2_20240105_10", 0), ("watermark_cut2_20240105_09", 1)]
    late = select_ingest_files(lst, "2024-01-05 10:10:00").collect()
    assert [r["file_key"] for r in late] == ["watermark_cut2_20240105_10"]
    assert all(r["size"] > 0 for r in lst.collect())


def test_every_byte_is_read_once(spark, tmp):
    """After ``read_log`` the logs may be gone: rows, rejected and corrupt read the one copy."""
    import os
    a = write_hourly(tmp, "2024-01-05", 7, [row(lite=str(k)) for k in range(500)], raw_lines=["1;2"])
    b = write_hourly(tmp, "2024-01-05", 8, [row(lite="b")], header=HEADER[:-1])
    c = write_hourly(tmp, "2024-01-05", 9, [row(lite="c")], header=list(reversed(HEADER)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        r = _read(spark, [a, b, c], on_corrupt="flag")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for p in (a, b, c):
        os.remove(p)
    rows = r.rows.collect()
    assert len({x["block_start"] for x in rows}) > 5
    assert sorted(x["lite_id"] for x in rows if not x["_corrupt"]) == sorted([str(k) for k in range(500)] + ["c"])
    assert [x["reason"][:15] for x in r.rejected.collect()] == ["Missing columns"] and r.corrupt.count() == 1
    assert all("log_lines" in f for f in r.rows.inputFiles())
    r.release()
    assert not any(os.path.exists(c.replace("file:", "")) for c in r.copies)


def test_quoted_fields_blank_lines_bom_and_line_ends(spark, tmp):
    import os
    path = os.path.join(tmp, "2024", "01", "05", "07.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "wb") as f:
        f.write(b'\r\n\xef\xbb\xbf"Time";Lite id;"Cap id"\r\n   \r\n07:00:00;"1;5";"say ""x"""\r\n;;\r\n"";2;\r\n')
    r = read_log(spark, [path], ";", ("time", "lite_id", "cap_id"))
    assert [(x["time"], x["lite_id"], x["cap_id"]) for x in r.rows.orderBy("row_pos").collect()] == [
        ("07:00:00", "1;5", 'say "x"'), (None, None, None), (None, "2", None)]
    assert r.rejected.count() == 0


def test_empty_file_and_lossy_text(spark, tmp):
    import os
    good = write_hourly(tmp, "2024-01-05", 6, [row(lite="1")], encoding_bytes=b"07:00:00;\xc3\x28" + b";1" * (len(HEADER) - 2) + b"\n")
    empty = os.path.join(tmp, "2024", "01", "05", "07.csv")
    open(empty, "w").close()
    r = _read(spark, [good, empty], strict_utf8=False)
    assert sorted(x["lite_id"] for x in r.rows.collect()) == ["1", "�("]
    assert [(x["path"], x["reason"]) for x in r.rejected.collect()] == [(empty, "empty file or no header")]


def test_written_logs_come_back_in_order(spark, tmp):
    from vitrine.plans.log_files import log_line, write_hourly_logs, write_plate_logs
    rows = spark.range(5000).select(F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, id % 3)").alias("file_hour"),
                                    F.col("id").alias("place"), log_line(";", F.col("id"), F.lit(None), F.lit("x")).alias("line"))
    heads = rows.select("file_hour", F.lit(-1).cast("long").alias("place"), F.lit("A;B;C").alias("line")).distinct()
    paths = write_hourly_logs(rows.unionByName(heads), tmp)
    assert [p[-17:] for p in paths] == [f"2024/01/05/{h:02d}.csv" for h in range(3)]
    got = read_log(spark, paths, ";", ("a", "b", "c")).rows.orderBy("file_hour", "block_start", "row_pos").collect()
    assert [(r["a"], r["b"], r["c"]) for r in got] == [(str(k), None, "x") for h in range(3) for k in range(h, 5000, 3)]
    days = spark.range(3).select(F.expr("date_add(date'2024-01-30', cast(id as int))").alias("file_date"), F.lit(0).alias("place"), F.lit("x").alias("line"))
    assert [p[-32:] for p in write_plate_logs(days, tmp)] == [f"/{d[:7]}/{d}-PlateLog.txt" for d in ("2024-01-30", "2024-01-31", "2024-02-01")]
