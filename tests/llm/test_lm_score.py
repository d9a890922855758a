import math
import zlib
from collections import Counter

import numpy as np

from vitrine.llm import lm_score as M


def brute_base(rows):
    """[(doc_id, text)] -> {position: (held_out, n_tokens, n_known, N, base)}"""
    toks = [(t or "").encode().lower().split() + [None] for _, t in rows]
    held = [i is None or zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    c = Counter(w for ws, h in zip(toks, held) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
            for (i, _), ws, h in zip(rows, toks, held)]


def check(got, rows):
    order = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    want = sorted(brute_base(rows), key=order)
    got = sorted((tuple(r) for r in got), key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(g[6]) and g[6] < 0
    return got


def test_query_matches_brute_force_and_beats_counts(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = check(M.op3_lm_score(spark, sf).collect(), rows)
    held = [r for r in got if r[1]]
    assert len(held) > 50
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than counts on unseen documents


def network(rng, classes=3, members=4, hidden=3, scale=0.5):
    size = M.Network(classes, members, hidden, None, (np.zeros(classes), np.zeros((classes, members)))).vector.size
    return M.Network(classes, members, hidden, rng.normal(0, scale, size))


def plain_loss(v, net, inputs, targets):
    """-log P of every target, one lane after the other, both softmaxes in double precision."""
    n = M.Network(net.n, net.members, net.hidden, v)
    p, k, at = {}, n.hidden, 0
    for name, shape in n.shapes.items():
        p[name] = np.asarray(v, np.float64)[at:at + int(np.prod(shape))].reshape(shape)
        at += int(np.prod(shape))
    total = 0.0
    for lane in range(inputs.shape[1]):
        h = np.zeros(k)
        for x, y in zip(inputs[:, lane], targets[:, lane]):
            if x == 0:
                h = np.zeros(k)
            w, a = h @ p["u"], p["x"][x]
            z, r = np.split(1 / (1 + np.exp(-(a + w)[:2 * k])), 2)
            new = np.tanh(a[2 * k:] + r * w[2 * k:])
            h = new + z * (h - new)
            c, m = divmod(y, n.members)
            outer, inner = h @ p["v"] + p["b"], h @ p["vm"][c] + p["bm"][c]
            total -= outer[c] - np.log(np.exp(outer).sum()) + inner[m] - np.log(np.exp(inner).sum())
    return total


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    net = network(rng)
    window = rng.integers(0, 12, (6, 2)), rng.integers(0, 12, (6, 2))
    g, _ = net.window_gradient(*window, np.zeros((3, 2), np.float32))
    for k in rng.choice(len(net.vector), 60, replace=False):
        v = net.vector.astype(np.float64)
        a, b = v.copy(), v.copy()
        a[k] += 1e-4
        b[k] -= 1e-4
        assert abs((plain_loss(a, net, *window) - plain_loss(b, net, *window)) / 2e-4 / 12 - g[k]) < 1e-4


def test_state_is_carried_across_windows(monkeypatch):
    rng = np.random.default_rng(1)
    net = network(rng, hidden=4, scale=1)
    seqs = [rng.integers(1, 12, n) for n in (0, 1, 7, 200, 63, 64, 65)]
    whole = net.log10(seqs)
    for steps, docs, rows in ((3, 2, 5), (1000, 1, 1000)):
        monkeypatch.setattr(M, "SCORE_STEPS", steps)
        monkeypatch.setattr(M, "SCORE_DOCS", docs)
        monkeypatch.setattr(M, "SCORE_ROWS", rows)
        assert np.allclose(net.log10(seqs), whole, atol=1e-3)
    plain = [-plain_loss(net.vector, net, np.r_[0, s][:, None], np.r_[s, 0][:, None]) / np.log(10) for s in seqs]
    assert np.allclose(plain, whole, atol=1e-3)
    assert len(net.log10([])) == 0


def test_within_class_softmax_follows_the_state():
    """The member of a class is learned from the history: after a comes b, after c comes d."""
    a, b, c, d = (M.MEMBERS * 2 + k for k in (1, 2, 3, 4))
    rng = np.random.default_rng(2)
    docs = [np.ravel([((a, b), (c, d))[k] for k in rng.integers(0, 2, 200)]) for _ in range(40)]
    net = M.Network(M.CLASSES, M.MEMBERS, M.HIDDEN, None, (np.zeros(M.CLASSES), np.zeros((M.CLASSES, M.MEMBERS))))
    for _ in range(20):
        net.fit(docs, 0.03)
    right, wrong = net.log10([np.array([a, b, c, d] * 10), np.array([a, d, c, b] * 10)])
    assert right > -20 and wrong < right - 20  # half the words are free: about 6 units, all in the class


def test_probabilities_add_up(monkeypatch):
    monkeypatch.setattr(M, "MEMBERS", 3)
    # classes end, rest, "on"; the rest's tail: two words (counts 1 and 3), the members "a" and nothing
    c = M.Classes({b"on": 2}, {b"a": 4, b"on": 7}, np.array([[5.0, 0, 0], [4, 3, 0], [6, 9, 0]]), np.array([0.0, 2, 2]))
    assert c.of(b"a") == 4 and c.of(b"station") == 6 and c.of(b"on") == 7 and c.of(b"zz") == 3 and c.of("é".encode()) == 3
    tail = c.inside(np.array([1, 3, 0]), np.array([3, 3, 3]))  # two known words and the unknown one
    assert abs((10 ** tail).sum() - 1) < 1e-9
    assert c.inside(np.array([3, 9, 5]), np.array([4, 7, 0])).tolist() == [0, 0, 0]
    net = M.Network(3, 3, 4, None, c.start())
    flat = np.random.default_rng(0).normal(0, 1, (9, 4)).astype(np.float32)
    for row in flat:
        assert abs(np.exp(net.log_prob(np.tile(row, (9, 1)), np.arange(9))).sum() - 1) < 1e-4
    assert net.log_prob(flat[:1], np.array([5]))[0] < -20  # a member that its class does not have


def test_edge_rows(spark):
    rows = [(k, f"The cat{k % 5} sat on the mat " * (k % 4)) for k in range(40)] + [(None, "the cat1"), (3, "dup"), (3, "dup"), (41, None), (42, ""), (43, "x " * 30000)]
    df = spark.createDataFrame([(i, t, b"x") for i, t in rows], "doc_id long, text string, block binary")
    check(M.score_documents(df.repartition(3)).collect(), rows)
    assert M.score_documents(df.limit(0)).count() == 0
    alone = M.score_documents(spark.createDataFrame([(None, "a b")], "doc_id long, text string")).collect()
    assert len(alone) == 1 and alone[0].n_known == 0 and alone[0].train_tokens == 0


def test_members_are_the_most_frequent_words(spark):
    text = " ".join(f"w{k}on " * (100 - k) for k in range(60)) + " zz" * 5
    df = spark.createDataFrame([(1, text), (2, "w3on zz yy")], "doc_id long, text string")
    totals = M.word_totals(M.word_requests(M.blocks(df), 5))
    c = M.learn_classes(totals, 2)
    on = c.endings[b"on"] * M.MEMBERS
    assert [c.of(f"w{k}on".encode()) - on for k in range(M.MEMBERS - 1)] == list(range(1, M.MEMBERS))
    rest = [100 - k for k in range(M.MEMBERS - 1, 60)]
    assert c.of(b"w50on") == on and c.tokens[on // M.MEMBERS, 0] == sum(rest) and c.types[on // M.MEMBERS] == len(rest)
    assert c.tokens.sum() == sum(100 - k for k in range(60)) + 1 + 6 + 1 + 2 and c.tokens[M.END, 0] == 2
