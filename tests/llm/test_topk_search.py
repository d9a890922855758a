import duckdb
import numpy as np

from vitrine.llm import topk_search as M


def brute(codes, queries, k):
    out = []
    for q, c in queries:
        near = sorted((bin((c ^ d) & (2**64 - 1)).count("1"), i) for i, d in codes if i != q)[:k]
        out += [(q, r + 1, i, h) for r, (h, i) in enumerate(near)]
    return sorted(out)


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = sorted(con.execute(M.ORACLE_SQL).fetchall())
    got = sorted((r.query_id, r["rank"], r.vec_id, r.distance) for r in M.op10_topk_search(spark, sf).collect())
    assert got == want and len(got) == 50


def test_clusters_copies_and_ties(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-2**63, 2**63, 6, dtype=np.int64).tolist()
    codes = []
    for i in range(240):
        c = centres[i % 6]
        for _ in range(i % 4):
            c ^= 1 << int(rng.integers(0, 63))
        codes.append((i, c))
    codes += [(1000 + i, centres[0]) for i in range(40)]  # a hot code
    df = spark.createDataFrame(codes, "vec_id long, code long")
    got = [tuple(r) for r in M.top_k(df, df.where("vec_id % 40 = 0"), 7).collect()]
    assert sorted(got) == brute(codes, [x for x in codes if x[0] % 40 == 0], 7)


def test_fewer_rows_than_k_and_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    up = [1.0] * 64
    rows = [(0, up), (0, up), (1, [-1.0] * 64), (2, up[:63] + [0.0]), (3, None), (4, up[:63]), (5, up[:63] + [nan]), (6, up[:63] + [inf]),
            (7, up[:63] + [None]), (None, up)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, code int")
    codes = M.sign_codes(df)
    got = [tuple(r) for r in M.top_k(codes, codes.where("vec_id % 100 = 0"), 10).collect()]
    assert sorted(got) == [(0, 1, 2, 1), (0, 2, 1, 64)]
    none = M.sign_codes(df.limit(0))
    assert M.top_k(none, none, 10).count() == 0
    single = codes.where("vec_id = 0")
    assert M.top_k(single, single, 10).count() == 0


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    con.executemany("INSERT INTO embeddings VALUES (?, ?)", rows)
    return sorted(con.execute(M.ORACLE_SQL).fetchall())


def test_an_id_with_several_codes_equals_the_sql(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vec = lambda: rng.choice([-1.0, 1.0], 64).tolist()
    for rows in ([(100, vec()), (100, vec()), (7, vec()), (8, vec())],
                 [(k % 90 * 10, vec()) for k in range(300)] + [(100, vec()), (100, vec()), (None, vec()), (3, None)]):
        df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, code int, q string")
        monkeypatch.setattr(M, "table", lambda *a: df)
        got = sorted((r.query_id, r["rank"], r.vec_id, r.distance) for r in M.op10_topk_search(spark, "").collect())
        assert got == by_sql(rows)


def test_segments_cover_the_code_and_follow_the_size():
    for n in (0, 1, 500, 2000, 51_282, 10**9):
        cut = M.segments(n)
        assert [a for a, _ in cut] == [sum(w for _, w in cut[:k]) for k in range(len(cut))] and sum(w for _, w in cut) == M.BITS
        assert max(w for _, w in cut) <= M.WIDTH
    assert len(M.segments(51_282)) == 5 and len(M.segments(10**9)) == 4
