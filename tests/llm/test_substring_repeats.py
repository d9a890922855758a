from pyspark.sql import functions as F

from vitrine.llm import substring_dedup as M


def test_repeated_rows_name_their_places_once(spark):
    passage = " ".join(f"w{k}" for k in range(70))
    one = [(1, "a b c " + passage), (None, passage + " d"), (2, "e " + passage)]
    many = one + one[1:] * 40

    def starts(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumn("rid", M.row_key(F.col("text")))
        return {(r.doc_id, r.rid): sorted(r.starts, key=str) for r in M.covered_starts(df).collect()}

    want = starts(one)
    assert set(k for k, _ in want) == {None, 2}
    got = starts(many)
    assert got.keys() == want.keys()
    for rows in got.values():
        places = [x.start for x in rows]
        assert len(places) == len(set(places))
    kept = M.remove_repeats(spark.createDataFrame(many, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.kept) for r in kept) == sorted([(1, 0, one[0][1])] + [(0, 70, "d"), (2, 70, "e")] * 41)
