import math

import numpy as np
import pytest

from vitrine.llm import whitening as M

SCHEMA = "vec_id long, embedding array<float>, label int, index long, x int, vector string, values int, part int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "v", 4, 5) for i, v in rows], SCHEMA)


def brute(rows, most=32):
    """{row number: (vec_id, deviation, whitened by component up to sign)}, explained."""
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = np.array([[(n * a - s) / n for a, s in zip(r, sums)] for r in x])
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    k = min(most, int((e > 1e-11 * e[0]).sum()))
    return [i for i, _ in rows], n, dev, centred @ v[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def check(got, rows):
    ids, n, dev, white, share = brute(rows)
    k = white.shape[1]
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert r.n == n and 0 <= r.identity_error <= 1e-8
        assert abs(r.explained - share[r.component - 1]) <= 1e-9
    signs = {}
    for i, d, w in zip(ids, dev, white):
        mine = by[i, d]
        for c in range(k):
            vals = mine[c + 1]
            s = signs.get(c)
            if s is None and abs(w[c]) > 1e-3:
                s = signs[c] = 1 if abs(vals[0] - w[c]) < abs(vals[0] + w[c]) else -1
            if s:
                assert min(abs(x - s * w[c]) for x in vals) < 1e-6


def op(spark, rows, monkeypatch):
    monkeypatch.setattr(M, "table", lambda *a: table(spark, rows))
    return M.op12_whitening(spark, "").collect()


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(M.op12_whitening(spark, sf).collect(), rows)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_blocks_of_any_size(spark, monkeypatch, block):
    monkeypatch.setattr(M, "block_rows", lambda n, d: block)
    rng = np.random.default_rng(block)
    rows = [(k, (rng.normal(size=5) * [5, 3, 1, 0.4, 0.2] + [100, -7, 0, 2, 9]).tolist()) for k in range(60)]
    check(op(spark, rows, monkeypatch), rows)


def test_unsound_rows_repeats_and_null_ids(spark, monkeypatch):
    rng = np.random.default_rng(1)
    good = [(k, rng.normal(size=4).tolist()) for k in range(80)]
    good += [(3, good[3][1])] * 3 + [(None, good[5][1])]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [float("nan")] * 4), (204, [float("inf"), 0.0, 0.0, 0.0])]
    check(op(spark, good + bad, monkeypatch), good)
    other = [(300, [1.0, 2.0]), (301, [9e9, 0.0, 0.0, 0.0])]  # another length; entry too large
    check(op(spark, good + other, monkeypatch), good)


def test_rank_deficient_data_has_fewer_components(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(k, [float(a), float(b), float(a), 1.0]) for k, (a, b) in enumerate(rng.normal(size=(50, 2)) * 9)]
    got = op(spark, rows, monkeypatch)
    assert {r.component for r in got} == {1, 2}
    check(got, rows)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]])
def test_no_spread_no_rows(spark, monkeypatch, rows):
    assert op(spark, rows, monkeypatch) == []


def test_deviation_too_large_for_a_long_is_null(spark, monkeypatch):
    rows = [(k, [1e7 * (-1) ** k, float(k)]) for k in range(40)]
    got = op(spark, rows, monkeypatch)
    assert {r.deviation for r in got} == {None} and len(got) == 40  # the second eigenvalue is under LEAST of the first
