import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from vitrine.llm import packing as M

JSON = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [0]


def check(pieces, rows, reference, seq_len=1024):
    """pieces: Row list; rows: [(doc_id, text, source)] with distinct ids."""
    want = {i: reference(t) for i, t, _ in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for i, ids in want.items():
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    total = sum(map(len, want.values()))
    assert sorted(by_seq) == list(range(-(-total // seq_len)))
    for s, ps in by_seq.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == min(seq_len, total - s * seq_len)
    return by_seq, total


def test_query_packs_everything_in_proportion(spark, sf_small, reference):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()]
    by_seq, total = check(M.op5_packing(spark, sf_small).collect(), docs, reference)
    source = {i: s for i, _, s in docs}
    share = defaultdict(int)
    for i, t, s in docs:
        share[s] += len(reference(t)) / total
    for s, ps in by_seq.items():
        if (s + 1) * 1024 <= total:
            got = defaultdict(int)
            for p in ps:
                got[source[p.doc_id]] += p.length
            assert all(abs(got[q] - 1024 * share[q]) < 3 for q in share)


def test_targets_drained_queues_and_nulls(spark, reference):
    rows = [(k, "word " * (k % 40), None if k % 5 == 0 else f"s{k % 3}") for k in range(60)]
    rows += [(100, None, "s0"), (101, "", None), (102, "<|endoftext|> a  b\n\n c", "s1"), (103, "x" * 5000, "s2")]
    df = spark.createDataFrame([(i, t, s, 9, b"z") for i, t, s in rows], "doc_id long, text string, source string, n int, ids binary")
    targets = {None: 1, "s0": 5, "s1": 2, "s2": 2}
    out = M.pack(df.repartition(4), JSON, P.PATTERN, targets, seq_len=64)
    pieces = out.collect()
    check(pieces, rows, reference, 64)
    first = [p for p in pieces if p.sequence_id < 3]
    assert abs(sum(p.length for p in first if p.source == "s0") - 96) <= 2  # half of 192
    for p in pieces:
        assert zlib.crc32(p.ids) == p.ids_crc32


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s"), (None, "d", "t")], "doc_id long, text string, source string")
    got = M.pack(df, JSON, P.PATTERN).collect()
    assert sum(p.length for p in got if p.doc_id == 1) == 8 and sum(p.length for p in got) == 10
    assert M.pack(df.limit(0), JSON, P.PATTERN).count() == 0


def test_encoder_equals_the_library(reference):
    enc = M.encoder(JSON, P.PATTERN)
    odd = ["", " ", "  ", "a  b", " a", "a\n\n b\n", "a \n b", "it's 'll\t\tx", "\x1c \x1d\x85 a\r\n\r\n  b ", "日本語 テスト 🙂 café",
           "12 34५६ ½ Ⅳ", "<|endoftext|> x", "a \0 b", "é", "ǅ ʰx", "x" * 3000, " ".join("ab,c. d" for _ in range(50))]
    for text, ids in zip(odd, enc.encode(odd)):
        assert np.frombuffer(ids, enc.wide).tolist() == reference(text)[:-1], text


def test_robin_is_exact_and_monotone():
    rng = np.random.default_rng(1)
    for _ in range(5):
        totals = rng.integers(1, 5000, 7).tolist()
        r = M.Robin(totals, rng.random(7).tolist(), 16)
        sent = r.sent(np.arange(r.windows + 1))
        assert (np.diff(sent, axis=0) >= 0).all()
        assert (sent.sum(axis=1) == np.minimum(np.arange(r.windows + 1) * 16, sum(totals))).all()
        assert sent[-1].tolist() == totals


def test_ids_are_not_shuffled_to_learn_their_places(spark, tmp_path):
    """A row per source and partition travels, not the documents' ids."""
    rows = [(k, "some words, and more " * (k % 7), "st"[k % 2]) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = M.pack(docs, JSON, P.PATTERN)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"BroadcastHashJoin[^\n]*\n(?:[^\n]*(?:Project|Filter|ColumnarToRow)[^\n]*\n)*[^\n]*FileScan parquet \[doc_id", plan)


def test_words_marks_and_line_ends_share_one_cache():
    e = M.ByteLevelEncoder(JSON, P.PATTERN)
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    odd = ["..'s it's a 'sfoo x... y!? ,,b", "one.\ntwo, three\nfour", "a\n\nb\n c \nd\n", "٣٤, x٣.", "<|endoftext|>. ok", "é. ñandú,;\né",
           "'.", "' ,\" ,\" .", "\x01.a\x7f, b", "don't. I'll, y'all&&& z***", "x\x1c\ny\n\x85z\n w", "_a_ (b) [c]\n{d}", ""]
    for text in odd * 2:
        assert np.frombuffer(e.encode([text])[0], e.wide).tolist() == t.encode(text, add_special_tokens=False).ids, text
    e.encode(["alone alone"])
    assert e.known["alone"] and not hasattr(e, "word_ids")


def test_sources_in_blocks_of_their_own_are_solved_once(monkeypatch):
    """Twenty sources far apart, their rows in turn: a block is not solved again at every row."""
    monkeypatch.setattr(M, "BLOCK", 64)
    totals = [200_000] * 20
    r, solved, sent = M.Robin(totals, [1.0] * 20, 1024), [], M.Robin.sent
    monkeypatch.setattr(M.Robin, "sent", lambda self, w: solved.append(len(w)) or sent(self, w))
    for k in range(10):
        for q in range(20):
            r.pieces(q, 9_900 * q + 5 * k, 9_900 * q + 5 * k + 5)
    assert len(solved) <= 80
