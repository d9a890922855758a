import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitrine.functions.calendar import (partition_label, period_label, quarter_end,
                                        quarter_start, transition_hours, watermark_key)
from vitrine.functions.clean import (bounded_text, canonical_id, composite_key, event_time,
                                     log_time, normalize_name, null_markers, py_list_text,
                                     scan_position, to_bigint, to_category, to_double)
from vitrine.operators.archive import quarter_range
from vitrine.spec import INVALID_MARKERS


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("marker", INVALID_MARKERS)
def test_markers_are_null(spark, marker):
    assert one(spark, null_markers("x"), f"  {marker} ") is None
    assert one(spark, to_double("x"), marker) is None


@pytest.mark.parametrize("text,expected", [
    ("1.5", 1.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-2", -2.0), (" +7 ", 7.0),
    ("1,5", None), ("1.5d", None), ("1.5f", None), ("0x1p3", None), ("", None), ("abc", None),
])
def test_to_double(spark, text, expected):
    assert one(spark, to_double("x"), text) == expected


def test_nonfinite_numbers_pass(spark):
    import math
    assert math.isnan(one(spark, to_double("x"), "nan"))
    assert one(spark, to_double("x"), "inf") == float("inf")
    assert one(spark, to_double("x"), "NaN") is None  # the marker, case-sensitive


@pytest.mark.parametrize("text,expected", [
    ("12", 12), ("12.0", None), ("007", 7), ("+5", 5), ("", None), (" 3 ", 3),
    ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None), ("1e3", None),
])
def test_to_bigint(spark, text, expected):
    assert one(spark, to_bigint("x"), text) == expected


@pytest.mark.parametrize("text,expected", [
    ("07:05:03", dt.datetime(2024, 1, 5, 7, 5, 3)), ("7:05:03", dt.datetime(2024, 1, 5, 7, 5, 3)),
    ("07:05:03.123", None), ("24:00:00", None), ("bad", None), ("", None),
])
def test_event_time_strict(spark, text, expected):
    df = spark.createDataFrame([("2024-01-05", text)], "d string, t string")
    assert df.select(event_time("d", "t").alias("r")).first()["r"] == expected


def test_log_time_strips_fraction(spark):
    df = spark.createDataFrame([("2024/01/05 07:05:03.250",), ("2024/1/5 7:5:3",), ("bad",)], "x string")
    got = [r["r"] for r in df.select(log_time("x").alias("r")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 7, 5, 3), dt.datetime(2024, 1, 5, 7, 5, 3), None]


@pytest.mark.parametrize("cap,lite,expected", [
    (5, 4090, 11), (4095, 0, 4095), (0, 4095, 1), (10, 10, 0), (None, 3, None),
    (9223372036854775807, -9223372036854775808, 4095),
])
def test_scan_position_rollover(spark, cap, lite, expected):
    df = spark.createDataFrame([(cap, lite)], "c bigint, l bigint")
    assert df.select(scan_position("c", "l").alias("r")).first()["r"] == expected


def test_scan_position_matches_wraparound(spark):
    import random
    rnd = random.Random(7)
    pairs = [(rnd.randrange(-2**40, 2**40), rnd.randrange(-2**40, 2**40)) for _ in range(200)]
    df = spark.createDataFrame(pairs, "c bigint, l bigint")
    got = [r["r"] for r in df.select(scan_position("c", "l").alias("r")).collect()]
    assert got == [(c - l) % 4096 for c, l in pairs]


@pytest.mark.parametrize("raw,norm", [
    ("Cap id", "cap_id"), ("  Lite ID ", "lite_id"), ("Total-Result", "total_result"),
    ("leading__edge", "leading_edge"), ("Top Curv (mm)", "top_curv_mm"), ("_x_", "x"),
])
def test_normalize_name(raw, norm):
    assert normalize_name(raw) == norm


def test_ids_and_keys(spark):
    assert one(spark, canonical_id("x"), " 123.0 ") == "123"
    assert one(spark, canonical_id("x"), "007") == "007"
    df = spark.createDataFrame([(None, 4, dt.datetime(2024, 1, 5, 7, 5, 3), 2)],
                               "c bigint, l bigint, t timestamp_ntz, s bigint")
    assert df.select(composite_key("c", "l", "t", "s").alias("k")).first()["k"] == "|4|07:05:03|2"
    assert one(spark, to_category("x"), " OK ") == "OK"
    assert one(spark, to_category("x"), "1.#INF") is None


def test_text_helpers(spark):
    long = ",".join(str(i) for i in range(1000))
    r = one(spark, bounded_text("x"), long)
    assert r == long[:2000] + "...(truncated)"
    assert one(spark, bounded_text("x"), "1,2") == "1,2"
    df = spark.createDataFrame([(["a", "b"],), ([],)], "x array<string>")
    assert [r["r"] for r in df.select(py_list_text("x").alias("r")).collect()] == \
        [str(["a", "b"]), str([])]


@pytest.mark.parametrize("as_of", ["2025-01-10", "2025-01-15", "2025-01-16", "2025-02-01",
                                   "2025-04-01", "2025-12-31", "2024-03-16"])
def test_quarter_columns_match_python(spark, as_of):
    df = spark.createDataFrame([(as_of,)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(quarter_start(F.col("d")).alias("s"), quarter_end(F.col("d")).alias("e")).first()
    try:
        s, e = quarter_range(as_of)
    except ValueError:
        s, e = quarter_range(as_of, refuse_open=False)
    assert (r["s"], r["e"]) == (s, e)


def test_quarter_refuses_open_quarter():
    assert quarter_range("2025-04-15") == (dt.date(2025, 1, 1), dt.date(2025, 3, 31))
    with pytest.raises(ValueError):
        quarter_range("2025-04-16")


def test_labels_and_transition(spark):
    df = spark.createDataFrame([("2024-03-05 10:07:00",), ("2024-03-05 10:10:00",)], "t string") \
        .select(F.col("t").cast("timestamp_ntz").alias("t"))
    got = df.select(F.transform(transition_hours("t"), lambda h: watermark_key(h)).alias("k")).collect()
    assert got[0]["k"] == ["watermark_cut2_20240305_10", "watermark_cut2_20240305_09"]
    assert got[1]["k"] == ["watermark_cut2_20240305_10"]
    d = spark.createDataFrame([(dt.date(2024, 3, 5),)], "d date")
    r = d.select(partition_label("t1", F.col("d")).alias("p"),
                 period_label(F.col("d"), F.col("d")).alias("q")).first()
    assert r["p"] == "t1_2024_03_05" and r["q"] == "2024-03-05_a_2024-03-05"
