import random

from pyspark.sql import functions as F

from vitrine.operators.merge import insert_ignore, upsert
from vitrine.operators.sequence import last_write_wins, with_event_seq


def _rows(n=600, seed=3):
    rnd = random.Random(seed)
    out = []
    for pos in range(n):
        key = rnd.choice([None, 1, 2, 3]) if rnd.random() < 0.9 else 99
        out.append((f"f{rnd.randint(0, 2)}", key, rnd.choice([None, "a", "b"]), pos))
    return out


def _expected(rows):
    seen, exp = {}, {}
    for f, k1, k2, pos in sorted(rows, key=lambda r: r[3]):
        g = (f, k1, k2)
        exp[pos] = seen.get(g, 0)
        seen[g] = exp[pos] + 1
    return exp


def test_event_seq_plain_and_split_agree(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "f string, k1 bigint, k2 string, pos bigint")
    exp = _expected(rows)
    for split_rows in (1, 7, 50, 1000):
        d = df.withColumn("split", F.floor(F.col("pos") / split_rows).cast("bigint"))
        got = with_event_seq(d, ["k1", "k2"], ["split", "pos"], scope_cols=["f"], split_col="split")
        assert {r["pos"]: r["event_seq"] for r in got.collect()} == exp
    plain = with_event_seq(df, ["k1", "k2"], ["pos"], scope_cols=["f"])
    assert {r["pos"]: r["event_seq"] for r in plain.collect()} == exp


def test_hot_key_is_dense(spark):
    # one key holds most rows and spans many splits: numbering stays 0..n-1
    rows = [("f", 1, "a", i) for i in range(500)] + [("f", 2, "a", 500 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "f string, k1 bigint, k2 string, pos bigint") \
        .withColumn("split", F.floor(F.col("pos") / 16).cast("bigint"))
    got = with_event_seq(df, ["k1", "k2"], ["split", "pos"], scope_cols=["f"], split_col="split")
    hot = sorted(r["event_seq"] for r in got.where("k1 = 1").collect())
    assert hot == list(range(500))


def test_four_identical_events(spark):
    df = spark.createDataFrame([(1, 2, "07:00:00", i) for i in range(4)], "c long, l long, t string, p long")
    got = with_event_seq(df, ["c", "l", "t"], ["p"]).orderBy("p")
    assert [r["event_seq"] for r in got.collect()] == [0, 1, 2, 3]


def test_last_write_wins(spark):
    df = spark.createDataFrame([(1, 0, "old"), (1, 1, "new"), (2, 0, "only")], "k long, o int, v string")
    got = {r["k"]: r["v"] for r in last_write_wins(df, ["k"], [F.col("o").desc()]).collect()}
    assert got == {1: "new", 2: "only"}


def test_upsert_and_ignore_null_safe(spark):
    ex = spark.createDataFrame([(1, "a", "e1"), (None, "b", "e2"), (3, "c", "e3")], "k long, j string, v string")
    st = spark.createDataFrame([(None, "b", "s2"), (4, "d", "s4"), (1, "a", "s1")], "k long, j string, v string")
    up = sorted((r["k"] or -1, r["v"]) for r in upsert(ex, st, ["k", "j"]).collect())
    assert up == [(-1, "s2"), (1, "s1"), (3, "e3"), (4, "s4")]
    ig = sorted((r["k"] or -1, r["v"]) for r in insert_ignore(ex, st, ["k", "j"]).collect())
    assert ig == [(-1, "e2"), (1, "e1"), (3, "e3"), (4, "s4")]
    twice = upsert(upsert(ex, st, ["k", "j"]), st, ["k", "j"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, upsert(ex, st, ["k", "j"]).collect()), key=str)
