import numpy as np
import pytest

from vitrine.llm import lm_score as M


@pytest.mark.parametrize("sizes", [[0], [1], [15, 1], [700, 0, 333, 64, 5], [64 * 16 - 1], [64 * 16], [5000], [512 * 16 + 1]])
def test_every_token_reaches_the_gradient(monkeypatch, sizes):
    rng = np.random.default_rng(3)
    docs = [rng.integers(1, 6, n) for n in sizes]
    seen, whole = [], M.Network.window_gradient

    def spy(self, inputs, targets, h):
        seen.extend(zip(inputs[targets >= 0].tolist(), targets[targets >= 0].tolist()))
        return whole(self, inputs, targets, h)

    monkeypatch.setattr(M.Network, "window_gradient", spy)
    n = M.Network(2, 3, 4, None, (np.zeros(2), np.zeros((2, 3)))).fit(docs, 0.01)
    want = [p for d in docs for p in zip([M.END, *d.tolist()], [*d.tolist(), M.END])]
    assert n == len(want) == len(seen) and sorted(seen) == sorted(want)


def test_padding_has_no_gradient():
    rng = np.random.default_rng(4)
    net = M.Network(2, 3, 3, None, (np.zeros(2), np.zeros((2, 3))))
    x, y = rng.integers(0, 6, (6, 2)), rng.integers(0, 6, (6, 2))
    g, _ = net.window_gradient(x, y, np.zeros((3, 2), np.float32))
    pad = np.full((3, 2), M.END), np.full((3, 2), -1)
    got, _ = net.window_gradient(np.r_[x, pad[0]], np.r_[y, pad[1]], np.zeros((3, 2), np.float32))
    assert np.allclose(got, g, atol=1e-6)


def test_each_learning_document_changes_the_network(spark):
    classes = M.Classes({}, {b"a": M.MEMBERS + 1, b"b": M.MEMBERS + 2}, np.zeros((M.CLASSES, M.MEMBERS)), np.zeros(M.CLASSES))
    classes.tokens[0, 0], classes.tokens[1, :3] = 1, (0, 5, 5)
    start = M.Network(M.CLASSES, M.MEMBERS, M.HIDDEN, None, classes.start()).vector
    for doc_id in (1, 2, 3, 4, None, next(k for k in range(100) if M.is_held_out(k))):
        df = spark.createDataFrame([(doc_id, "a b a a b")], "doc_id long, text string")
        fitted = not np.array_equal(M.fit_network(M.blocks(df), classes), start)
        assert fitted == (not M.is_held_out(doc_id)), doc_id
