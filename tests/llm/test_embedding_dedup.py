import numpy as np

from vitrine.llm.embedding_dedup import embedding_groups, op8_embedding_dedup


def brute(rows, threshold=0.95):
    """[(vec_id, list)] -> [(vec_id, n_links, component_id)] in row order."""
    def sound(v):
        return (v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v))
    n = len(rows)
    links = {k: [] for k in range(n)}
    for i in range(n):
        for j in range(i):
            a, b = rows[i][1], rows[j][1]
            if sound(a) and sound(b) and len(a) == len(b):
                a, b = np.array(a, float), np.array(b, float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold:
                    links[i].append(j)
                    links[j].append(i)
    comp = [None] * n
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for y in links[stack.pop()]:
                if y not in seen:
                    seen.add(y)
                    stack.append(y)
        comp[i] = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
    return [(rows[i][0], len(links[i]), comp[i]) for i in range(n)]


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0)


def test_query_matches_brute_force(spark, sf_small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_small}/embeddings.parquet").collect()]
    got = op8_embedding_dedup(spark, sf_small).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def planted():
    rng = np.random.default_rng(4)
    rows = []
    for c in range(8):
        centre = rng.standard_normal(16)
        for _ in range(3 + 12 * (c == 0)):
            v = centre + 0.05 * rng.standard_normal(16)
            rows.append((len(rows), v.tolist()))
            if c % 2:
                rows.append((len(rows), v.tolist()))  # an exact copy
                rows.append((len(rows), (v * 3).tolist()))
    return rows


def test_planted_groups_and_blocks(spark):
    rows = planted()
    want = sorted(brute(rows), key=key)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block in (2048, 4):  # small blocks cut the dense bucket
        got = [(r.vec_id, r.n_links, r.component_id) for r in embedding_groups(df, block=block).collect()]
        assert sorted(got, key=key) == want


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]),
            (8, [1.0, 1.0, 0.0]), (9, [2.0, 2.0]), (9, [2.0, 2.0]), (None, [3.0, 3.0]), (None, [-5.0, 1.0]), (10, [-0.0, 1.0]),
            (11, [0.0, 1.0]), (12, [1e300, 1e300]), (13, [0.0, -1.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, k int, vec string")
    got = [(r.vec_id, r.n_links, r.component_id) for r in embedding_groups(df).collect()]
    assert len(got) == len(rows)
    by = {i: (n, c) for i, n, c in got if i is not None}
    for i in (1, 2, 3, 4, 5, 6, 8, 13):
        assert by[i] == (0, i)
    assert by[7] == by[9] == by[12] == (4, 7) and (None, 4, 7) in got
    assert by[10] == (1, 10) and by[11] == (1, 10)
    assert sum(1 for i, n, c in got if i is None) == 2


def test_empty_table(spark):
    assert embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_recall_at_the_threshold():
    """Pairs at exactly the threshold still meet in 9 of 10 cases."""
    from vitrine.llm.embedding_dedup import PROJECTIONS, SEED, TABLES, WIDTH, signatures, unit
    rng = np.random.default_rng(6)
    a = unit(rng.standard_normal((2000, 64)))
    d = rng.standard_normal((2000, 64))
    d = unit(d - (d * a).sum(1, keepdims=True) * a)
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * d
    met = (signatures(a, TABLES, PROJECTIONS, WIDTH, SEED) == signatures(b, TABLES, PROJECTIONS, WIDTH, SEED)).any(1)
    assert met.mean() > 0.9
