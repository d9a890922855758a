import itertools

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from tokenizers import Tokenizer

from vitrine.llm import byte_bpe as M
from vitrine.llm import packing

RANKS, JSON = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
RUNS = ["".join(x) for n in range(1, 5) for x in itertools.product("  \t\n", repeat=n)]
MIXED = ["a     b", "   a", "a   ", "\0 \t a  \0", "it's  \x1c x\x85 y", *[f"a{x}b,{x}1 \0{x}" for x in RUNS]]


@pytest.fixture(scope="module")
def rank_ids():
    t = tiktoken.Encoding("given", pat_str=P.PATTERN, mergeable_ranks=M.load_ranks(RANKS), special_tokens={})
    return t.encode_ordinary


def test_mixed_white_space_runs_equal_the_libraries(rank_ids):
    assert rank_ids(MIXED[0]) == [64, 11504, 275]
    for text, (ids, raw) in zip(MIXED, M.Codec(RANKS, P.PATTERN).encode_texts(MIXED)):
        assert list(map(int, ids.split())) == rank_ids(text) and raw == text.encode(), repr(text)
    enc = packing.ByteLevelEncoder(JSON, P.PATTERN)
    tok = Tokenizer.from_file(JSON)
    tok.encode_special_tokens = True
    for text, ids in zip(MIXED, enc.encode(MIXED)):
        assert np.frombuffer(ids, enc.wide).tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_cuts_never_change_the_matches():
    words = regex.compile(P.PATTERN).findall
    for text in MIXED:
        chunks = M.text_chunks(text)
        assert "".join(chunks) == text
        assert [w for c in chunks for w in words(c)] == words(text), repr(text)
    assert M.text_chunks("a  b c") == ["a", "  b", " c"]


def by_library(rank_ids, text):
    import hashlib
    ids = rank_ids(text or "")
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_equals_the_library_on_whole_texts(spark, rank_ids):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = M.op2_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == by_library(rank_ids, texts[r.doc_id]) and r.round_trip


def test_edge_rows_and_long_words_equal_the_library(spark, rank_ids):
    long = ["a" * 3000, "ab" * 500, "xyzzy" * 97, "é" * 400, "!" * 700, "\U0001F600" * 120, "q" * 95, "q" * 96, "q" * 97, "0" * 200]
    texts = [None, "", " ", "a", "a", " ".join(long), *long, "word " * 60_000]
    rows = [(None if k == 3 else k % 20, t, "t", 1, "i") for k, t in enumerate(texts)] + [(7, "twice", "t", 1, "i")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int, data string")
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in M.bpe_round_trip(df, RANKS, P.PATTERN).collect())
    assert got == sorted((i is not None, i or 0, *by_library(rank_ids, t)) for i, t, *_ in rows)
    assert M.bpe_round_trip(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_encode_then_decode_gives_the_text_back(spark, rank_ids):
    texts = [None, "", "It's 3 o'clock,\n  isn't it?", "日本語 \u00a0 x", "y" * 500]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = M.encode(df, RANKS, P.PATTERN)
    assert {r.doc_id: r.ids for r in coded.collect()} == {k: rank_ids(t or "") for k, t in enumerate(texts)}
    back = {r.doc_id: bytes(r.data).decode() for r in M.decode(coded, RANKS, P.PATTERN).collect()}
    assert back == {k: t or "" for k, t in enumerate(texts)}
    none = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(M.decode(none, RANKS, P.PATTERN).first().data) == b""


def test_every_token_contracts_to_itself():
    """What contracting all places of a rank at once rests on, for the given ranks."""
    codec = M.Codec(RANKS, P.PATTERN)
    tokens = list(codec.ranks)
    out = [None] * len(tokens)
    codec._contract(tokens, list(range(len(tokens))), out)
    assert all(x == [codec.ranks[t]] for t, x in zip(tokens, out))


@pytest.mark.parametrize("history", [M.QUERY_ROWS, 1, 5000])
def test_words_of_any_length_equal_the_library(monkeypatch, history):
    monkeypatch.setattr(M, "QUERY_ROWS", history)
    monkeypatch.setattr(M, "QUERY_BYTES", 300)
    codec = M.Codec(RANKS, P.PATTERN)
    library = tiktoken.Encoding("given", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})._core_bpe
    rng = np.random.default_rng(5)
    words = [b"a" * n for n in (2, 3, 5, 8, 17, 1001)] + [b"aab" * 40, b"=" * 600]
    for letters in ("ab", "abc", "the in on", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ0123456789+/"):
        words += ["".join(rng.choice(list(letters), n)).encode() for n in (5, 40, 95, 97, 400)]
    words += [bytes(rng.integers(0, 256, 60, dtype=np.uint8)) for _ in range(20)]
    assert codec.encode_words(words) == [library.encode_single_piece(w) for w in words]
