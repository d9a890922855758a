"""Plans of the audit that decide how much one task holds, and rows that plans may lose."""

import re

import pytest

from vitrine.operators import reconcile as rc
from vitrine.operators.sequence import with_event_seq
from vitrine.plans import catalog
from vitrine.plans import transform as tf

ROWS = "line string, audited_date date, key string"


@pytest.fixture()
def plan(spark):
    """The plan as first made, with every shuffle and its reuse."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def rows(spark, *keys):
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{a}', {d}, {k})" for a, d, k in keys) + " AS t(line, audited_date, key)") \
        .selectExpr("line", "CAST(audited_date AS date)", "CAST(key AS string)")


@pytest.mark.parametrize("parts", [None, 5])
def test_pairs_of_null_days_and_keys(spark, parts):
    d = "DATE'2024-01-05'"
    log = rows(spark, ("A", d, "'1'"), ("A", d, "'1'"), ("A", d, "'2'"), ("A", d, "NULL"), ("A", "NULL", "'7'"))
    db = rows(spark, ("A", d, "'2'"), ("A", d, "'2'"), ("A", d, "'3'"), ("A", d, "NULL"), ("A", d, "NULL"), ("A", "NULL", "'7'"))
    got = sorted((str(r["audited_date"]), r["key"] or "", bool(r["in_log"]), r["n_db"] or 0) for r in rc.key_pairs(log, db, parts).collect())
    day = "2024-01-05"
    assert [g[:2] + g[3:] for g in got if not g[2]] == [(day, "", 2), (day, "3", 1), ("None", "7", 1)]
    assert [g[:2] + g[3:] for g in got if g[2]] == [(day, "1", 0), (day, "2", 2), ("None", "7", 0)]
    left = [(r["audited_date"] is None, r["key"]) for r in rc.only_left(log, db, parts).collect()]
    assert sorted(left) == [(False, "1"), (True, "7")]


@pytest.mark.parametrize("name", ["missing_in_db", "excess_in_db", "reconcile_ids", "audit_status", "audit_summary"])
def test_keys_are_aggregated_after_they_are_dealt(spark, sf_small, plan, name):
    """No hash table of a whole file split, no sort of either side's keys."""
    text = plan(catalog.QUERIES[name](spark, sf_small))
    assert "FullOuter" not in text and "LeftAnti" not in text
    dealt = text.split("REPARTITION_BY_NUM")[1:]
    assert dealt and not any("Aggregate(keys=[line" in x.split("Union")[0] for x in dealt)


def test_parts_follow_the_tables(spark, sf_small, monkeypatch):
    assert catalog._parts(spark, sf_small) == 4
    monkeypatch.setattr(catalog, "PART_BYTES", 1 << 10)
    assert catalog._parts(spark, sf_small) > 50


@pytest.mark.parametrize("name", ["missing_sample", "missing_ids_text"])
def test_ranks_are_sorted_apart_from_the_aggregation(spark, sf_small, plan, name):
    assert re.search(r"_s#\d+L?, \d+\), REPARTITION_BY_NUM", plan(catalog.QUERIES[name](spark, sf_small)))


def test_offsets_are_never_broadcast(spark, plan):
    df = spark.range(40).selectExpr("'f' AS f", "id % 2 AS k", "id AS pos", "id div 8 AS split")
    got = with_event_seq(df, ["k"], ["split", "pos"], scope_cols=["f"], split_col="split")
    assert got.columns == ["f", "k", "pos", "split", "event_seq"]
    assert "Broadcast" not in plan(got)
    assert {(r["k"], r["pos"], r["event_seq"]) for r in got.collect()} == {(i % 2, i, i // 2) for i in range(40)}


@pytest.mark.parametrize("name", ["audit_note", "audit_all_lines"])
def test_counts_and_lists_share_one_pass(spark, sf_small, plan, name):
    text = plan(catalog.QUERIES[name](spark, sf_small))
    assert len(re.findall("FileScan parquet .l_orderkey", text)) == 1 and "ReusedExchange" in text


def test_rerun_is_computed_once(spark, sf_small, plan):
    text = plan(catalog.QUERIES["audit_rerun"](spark, sf_small))
    assert len(re.findall("FileScan parquet .l_orderkey", text)) == 1
    assert len(re.findall("FileScan parquet .event_id", text)) <= 6


def test_null_day_has_counts_but_no_ids(spark):
    log = rows(spark, ("A", "DATE'2024-01-05'", "'1'"))
    db = rows(spark, ("A", "NULL", "'9'"))
    labels = spark.createDataFrame([("A", "IDs")], "line string, key_label string")
    got = {r["audited_date"] is None: (r["ids_missing"], r["n_extra"], r["note"]) for r in rc.audit_results(log, db, labels).collect()}
    assert got[False][0] == "1" and "['1']" in got[False][2]
    assert got[True][:2] == ("", 1) and got[True][2].endswith("sample: []")


def test_counters_are_dealt_by_table_size(spark, sf_small, plan, monkeypatch):
    """Both counters sort and count in as many tasks as the tables ask for, whatever the session's
    number, and no task counts a whole file split's groups before the shuffle."""
    monkeypatch.setattr(catalog, "PART_BYTES", 1 << 12)
    parts = catalog._parts(spark, sf_small, ("events",))
    assert parts > 4
    ev = catalog._t(spark, sf_small, "events")
    for rows in (tf.hourly_log_keys(catalog.cut2_raw(ev), parts=parts), catalog.cut2_table(ev, True, parts)):
        text = plan(rows)
        counts = set(re.findall(r", (\d+)\), (?:REPARTITION_BY_NUM|ENSURE_REQUIREMENTS)", text))
        assert counts == {str(parts)}
        assert re.search(r"partial_count\(1\)[^\n]*\n[^\n]*Exchange", text)
    found = catalog.QUERIES["reconcile_ids"](spark, sf_small)
    assert len(re.findall(rf"_s(?:q\d+v|plit)[^\n]*, {parts}\), REPARTITION_BY_NUM", plan(found))) >= 6


@pytest.mark.parametrize("parts", [3, 7])
def test_dealt_counters_equal_the_plain_window(spark, parts):
    df = spark.sql("SELECT CAST(IF(id % 5 = 0, NULL, id % 3) AS int) AS k, 'f' AS f, id AS pos, id div 4 AS split FROM range(60)")
    got = with_event_seq(df, ["k"], ["split", "pos"], scope_cols=["f"], split_col="split", parts=parts)
    want = with_event_seq(df, ["k"], ["pos"], scope_cols=["f"])
    assert got.schema.names == want.schema.names
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_summary_reads_the_keys_once(spark, sf_small, plan):
    text = plan(catalog.QUERIES["audit_summary"](spark, sf_small))
    assert len(re.findall("Union", text)) == 2 and text.count("SortMergeJoin [_sq") == 2
    got = rc.audited_days(*catalog._audit_sides(spark, sf_small))
    want = rc.reconcile_counts(catalog._pairs(spark, sf_small)).select("audited_date").distinct()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_survivors_of_the_shares_are_dealt_by_parts(spark, plan):
    keys = spark.sql("SELECT IF(id % 2 = 0, 'A', 'B') AS line, DATE'2024-01-05' + CAST(id % 3 AS int) AS audited_date, CAST(id AS string) AS key FROM range(90)")
    got = rc.first_ranks(keys, rc.DAY, 4, 5)
    assert re.findall(r"line#\d+, audited_date#\d+(?:, _s#\d+L?)?, (\d+)\), REPARTITION_BY_NUM", plan(got)) == ["5", "5"]
    assert sorted(map(str, got.collect())) == sorted(map(str, rc.first_ranks(keys, rc.DAY, 4).collect()))


def test_parts_follow_the_rows_of_tables_that_compress_well(spark, tmp):
    """Rows decide what a task holds; a few bytes of Parquet may hold a million of them."""
    spark.range(900_000).selectExpr("id div 100000 AS event_id").coalesce(1).write.parquet(f"{tmp}/events.parquet")
    assert catalog._parts(spark, tmp, ("events",)) == 9


def test_parts_stay_where_a_shuffle_is_written_row_by_row(spark, sf_small, monkeypatch):
    """With more parts the writer keeps a whole file split's rows in memory."""
    monkeypatch.setattr(catalog, "PART_ROWS", 1)
    assert catalog._parts(spark, sf_small) == 200
    spark.conf.set("spark.sql.shuffle.partitions", "300")
    try:
        assert catalog._parts(spark, sf_small) == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
