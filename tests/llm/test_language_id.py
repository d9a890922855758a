import zlib

import numpy as np

from vitrine.llm import language_id as M


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = M.op4_language_id(spark, sf).collect()
    assert len(got) == len(docs)
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert len(held) > 100 and right / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def small_model():
    rng = np.random.default_rng(0)
    word = lambda letters: "".join(rng.choice(list(letters), rng.integers(3, 8)))
    texts = {k: [" ".join(word(k) for _ in range(300)) for _ in range(3)] for k in ("abcde", "fghij", "klmno")}
    counts = {k: np.bincount(M.letter_trigrams(v)[0], minlength=M.BUCKETS) for k, v in texts.items()}
    return M.LanguageModel.of(counts), word


def test_mixture_proportions_and_language_set():
    model, word = small_model()
    mixed = " ".join([word("abcde") for _ in range(60)] + [word("klmno") for _ in range(40)])
    share = M.infer([mixed, " ".join(word("fghij") for _ in range(50)), "", None, "12 %% 34"], model)
    a, f, k = (model.langs.index(x) for x in ("abcde", "fghij", "klmno"))
    assert abs(share[0, a] - 0.6) < 0.05 and abs(share[0, k] - 0.4) < 0.05 and share[0, f] == 0
    assert share[1, f] == 1 and not share[2:].any()


def test_slices_do_not_change_the_result():
    model, word = small_model()
    texts = [" ".join(word(k) for _ in range(n)) for k, n in (("abcde", 1), ("fghij", 40), ("klmno", 7))] + [None, "?"]
    together = M.infer(texts, model)
    assert np.allclose(together, np.concatenate([M.infer([t], model) for t in texts]))


def test_edge_rows(spark):
    train = [(k, t, lang) for k, (t, lang) in enumerate([("aaa bab abba", "x"), ("zzz zyz", "y"), ("qqq", None), (None, "x")] * 6)]
    df = spark.createDataFrame(train, "doc_id long, text string, lang string")
    model = M.learn(df.select("text", "lang"))
    assert model.langs == ["x", "y"]
    rows = [(1, None), (2, ""), (3, "123 !"), (4, "baba"), (5, "zyzzy"), (6, "日本"), (None, "baba"), (4, "baba"), (7, "a" * 300_000)]
    got = M.identify(spark.createDataFrame([(i, t, "l", 0.5) for i, t in rows], "doc_id long, text string, lang_pred string, score double"), model).collect()
    by = [(r.doc_id, r.lang_pred) for r in got]
    assert len(got) == len(rows) and by.count((4, "x")) == 2 and (5, "y") in by and (None, "x") in by and (7, "x") in by
    assert all((r.lang_pred, r.score) == ("und", 0.0) for r in got if r.doc_id in (1, 2, 3))
    assert all(r.lang_pred in ("x", "y") for r in got if r.doc_id == 6)


def test_nothing_learned_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = M.learn(empty.select("text", "lang"))
    assert model.langs == [] and M.identify(empty, model).count() == 0
    got = M.identify(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), model).first()
    assert got.lang_pred == "und" and got.score == 0.0
