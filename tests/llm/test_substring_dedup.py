import hashlib
import random

import numpy as np

from vitrine.llm import substring_dedup as M


def brute(rows, window=50):
    """[(doc_id, text)] -> list of (doc_id, n_words, n_removed, sha) in row order."""
    least = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            if key not in least or least[key] is None or (i is not None and i < least[key]):
                least[key] = i
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        keep = [True] * len(w)
        for k in range(len(w) - window + 1):
            m = least[tuple(w[k:k + window])]
            if m is not None and (i is None or m < i):
                keep[k:k + window] = [False] * window
        kept = [x for x, y in zip(w, keep) if y]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def test_query_matches_brute_force(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    want = brute(rows)
    got = [tuple(r) for r in M.op6_substring_dedup(spark, sf_small).collect()]
    assert sorted(got) == sorted(want)
    assert any(r[2] for r in got) and any(not r[2] for r in got)


def test_planted_and_edge_rows(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(60)]
    rows = [(k, " ".join([word() for _ in range(rng.randint(0, 90))] + (passage[:rng.randint(45, 60)] if k % 3 else [])
                         + [word() for _ in range(20)])) for k in range(40)]
    rows += [(100, "x " * 200), (101, "x " * 120), (102, None), (103, ""), (104, " ".join(passage[:49])),
             (104, " ".join(passage)), (104, " ".join(passage)), (105, "\n\t" + "\n".join(passage) + "\x0b"),
             (None, " ".join(passage)), (None, "y " * 70), (None, "y " * 70)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, starts string").repartition(3)
    got = M.remove_repeats(df).collect()
    want = brute(rows)
    have = [(r.doc_id, r.n_words, r.n_removed, hashlib.sha256(b" ".join(M.split_words(r.kept))).hexdigest()) for r in got]
    order = lambda x: (x[0] is None, x)
    assert sorted(have, key=lambda x: (x[0] is None, str(x))) == sorted(want, key=lambda x: (x[0] is None, str(x)))
    assert [r.kept for r in got if r.doc_id == 102] == [None]


def test_empty_table(spark):
    assert M.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_saturated_sketch_loses_nothing(spark, sf_small, monkeypatch):
    """With far too few cells everything passes the prefilter and the result is the same."""
    monkeypatch.setattr(M, "sketch_cells", lambda *a: M.CHUNK)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    got = [tuple(r) for r in M.op6_substring_dedup(spark, sf_small).collect()]
    assert sorted(got) == sorted(brute(rows))


def test_sliding_minimum():
    a = np.random.default_rng(0).integers(0, 1000, 200).astype(np.uint64)
    for size in (1, 2, 3, 26, 31, 32):
        assert M._sliding_min(a, size).tolist() == [min(a[k:k + size]) for k in range(len(a) - size + 1)]
