"""Property checks: the guarded casts agree with an exact parse of the same text."""

from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.functions.clean import to_bigint, to_double

NUMBER = st.from_regex(r"\A[+-]?([0-9]{1,12}(\.[0-9]{0,8})?|\.[0-9]{1,8})([eE][+-]?[0-9]{1,2})?\Z",
                       fullmatch=True)
INTEGER = st.from_regex(r"\A[+-]?[0-9]{1,19}\Z", fullmatch=True)
JUNK = ["1,5", "1.5d", "1.5f", "0x1p3", "1_000", "--1", "1e", ".", "e5", "1.2.3", "12abc", "+",
        "1 2"]


@settings(max_examples=1, deadline=None)
@given(st.lists(NUMBER, min_size=200, max_size=200), st.lists(INTEGER, min_size=200, max_size=200))
def test_guarded_casts_match_exact_parse(spark, numbers, integers):
    df = spark.createDataFrame([(n, i) for n, i in zip(numbers, integers)], "n string, i string")
    got = df.select("n", "i", to_double("n").alias("d"), to_bigint("i").alias("b")).collect()
    for r in got:
        assert r["d"] == float(r["n"]), r["n"]
        v = int(r["i"])
        assert r["b"] == (v if -2**63 <= v < 2**63 else None), r["i"]


def test_junk_is_null(spark):
    df = spark.createDataFrame([(x,) for x in JUNK], "x string")
    rows = df.select(to_double("x").alias("d"), to_bigint("x").alias("b")).collect()
    assert all(r["d"] is None and r["b"] is None for r in rows)
