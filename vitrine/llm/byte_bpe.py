"""Byte-level BPE encoding and decoding with DuckDB recursive queries inside each Spark task.

A text is pre-split by the tokenizer's pattern; every *distinct* new word of a slice becomes
rows (word, position, token). A recursive query joins neighbouring tokens to the merge table,
takes each word's minimum-rank pair and contracts all its places from the left, until no pair of
the word is mergeable. That equals contracting one place after the other: a token is only formed
from tokens of lower rank, so a contraction gives no pair of a lower rank than its own. It holds
for the ranks of every trained byte-level BPE, whose tokens' own bytes contract to the token
(tested for the given file). So steps grow with the ranks that a word uses, not with its length,
and words of every length go the same way. Decoding joins token rows to the byte table and concatenates the bytes
with an ordered aggregate. Spark partitions the documents; a task holds one text slice, a
bounded cache of encoded chunks and one DuckDB connection.

Defined results: null or empty text: no tokens (``n_tokens`` 0, hashes of the empty string).
A null doc_id is kept as such; repeated rows give repeated result rows; extra columns are
ignored, whatever their names; an empty table gives an empty result. Texts and words of any
length are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Generations, claim, slices, table

#: Bytes of encoded chunks kept per Python worker.
CACHE_BYTES = 256 << 20
#: Words, and bytes of words, that one recursive query begins with (a longer word has its own).
QUERY_WORDS, QUERY_BYTES = 40_000, 400_000
#: Rows that the steps of one query may add up to; words not done by then go on in the next one.
QUERY_ROWS = 4_000_000
#: No next row, or no next token.
NONE = -1

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    T.StructField("round_trip", T.BooleanType()),
])

#: Working rows: word, position, token, and the next row's token and position. A step joins
#: every row to the merge table, finds each word's minimum rank and contracts all pairs of that
#: rank that do not overlap, from the left: of a run of equal tokens every second row. The merged
#: token takes the pair's first row, the row after it goes. A word without a mergeable pair is done.
ENCODE = """
WITH RECURSIVE
st(i, w, p, t, nt, np) AS (
    SELECT 0, w, p, t, nt, np FROM seed
  UNION ALL (
    WITH least AS (
        SELECT st.w, st.p, st.t, st.nt, st.np, g.m FROM st JOIN merges g ON g.a = st.t AND g.b = st.nt
        QUALIFY g.m = min(g.m) OVER (PARTITION BY st.w)),
    runs AS (
        SELECT p, np - p AS size, p - (np - p) * row_number() OVER (PARTITION BY w ORDER BY p) AS run FROM least WHERE t = nt),
    second AS (
        SELECT p FROM runs QUALIFY ((p - min(p) OVER (PARTITION BY run)) // size) % 2 = 1),
    heads AS (
        SELECT c.p, c.m, c.np AS gone, g.nt, g.np FROM least c JOIN st g ON g.p = c.np WHERE c.p NOT IN (SELECT p FROM second)),
    kept AS (
        SELECT s.i + 1 AS i, s.w, s.p, coalesce(h.m, s.t) AS t, coalesce(h.nt, s.nt) AS nt, coalesce(h.np, s.np) AS np
        FROM st s LEFT JOIN heads h ON h.p = s.p
        WHERE s.i < $depth AND s.w IN (SELECT w FROM least) AND s.p NOT IN (SELECT gone FROM heads))
    SELECT k.i, k.w, k.p, k.t, coalesce(h.m, k.nt), k.np FROM kept k LEFT JOIN heads h ON h.p = k.np)
),
done AS (SELECT w, max(i) AS i FROM st GROUP BY w)
SELECT st.i = $depth AS goes_on, st.w, st.p, st.t, st.nt, st.np FROM st JOIN done ON st.w = done.w AND st.i = done.i ORDER BY st.p
"""

DECODE = """
SELECT c.w, string_agg(v.hex, '' ORDER BY c.p) AS hex FROM coded c JOIN vocab v ON v.t = c.t GROUP BY c.w
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """The tokenizer of one Python worker: merge and byte tables in an in-process DuckDB."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.words = regex.compile(pattern).findall
        self.ranks = load_ranks(path)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "384MB"})
        toks = sorted(self.ranks.items(), key=lambda kv: kv[1])
        a, b, m = [], [], []
        for tok, rank in toks:
            for cut in range(1, len(tok)):
                left, right = self.ranks.get(tok[:cut]), self.ranks.get(tok[cut:])
                if left is not None and right is not None:
                    a.append(left), b.append(right), m.append(rank)
        self._fill("merges", {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "m": pa.array(m, pa.int64())})
        self._fill("vocab", {"t": pa.array([r for _, r in toks], pa.int64()), "hex": pa.array([t.hex() for t, _ in toks])})
        self.single = np.array([self.ranks[bytes([x])] for x in range(256)], np.int64)
        self.cache = Generations(CACHE_BYTES)

    def _fill(self, name: str, cols: dict | pa.Table) -> None:
        self.con.register("incoming", cols if isinstance(cols, pa.Table) else pa.table(cols))
        self.con.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM incoming")
        self.con.unregister("incoming")

    def encode_words(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word (distinct words, no pre-splitting)."""
        out: list = [None] * len(words)
        todo, held = [], 0
        for k, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:
                out[k] = [whole]
                continue
            if todo and (len(todo) == QUERY_WORDS or held + len(w) > QUERY_BYTES):
                self._contract(words, todo, out)
                todo, held = [], 0
            todo.append(k)
            held += len(w)
        if todo:
            self._contract(words, todo, out)
        return out

    def _contract(self, words: list[bytes], part: list[int], out: list) -> None:
        """Fill ``out`` for the words ``part`` by recursive queries of bounded history."""
        size = np.array([len(words[k]) for k in part])
        first = np.cumsum(size) - size
        t = self.single[np.frombuffer(b"".join([words[k] for k in part]), np.uint8)]
        p = np.arange(len(t))
        nt, np_ = np.append(t[1:], NONE), p + 1
        nt[first + size - 1] = np_[first + size - 1] = NONE
        rows = pa.table({"w": pa.array(np.repeat(np.arange(len(part)), size)), "p": pa.array(p), "t": pa.array(t),
                         "nt": pa.array(nt), "np": pa.array(np_)})
        while rows.num_rows:
            self._fill("seed", rows)
            got = self.con.sql(ENCODE, params={"depth": max(1, min(200, QUERY_ROWS // rows.num_rows))}).to_arrow_table()
            goes_on = got["goes_on"].to_numpy()
            ids, word = got["t"].to_numpy()[~goes_on], got["w"].to_numpy()[~goes_on]
            ends = np.append(np.flatnonzero(word[1:] != word[:-1]) + 1, len(word)) if len(word) else []
            flat, lo = ids.tolist(), 0
            for hi in ends:
                out[part[word[lo]]] = flat[lo:hi]
                lo = hi
            rows = got.filter(pa.array(goes_on)).drop_columns(["goes_on"])

    def decode_words(self, coded: list[list[int]]) -> list[bytes]:
        """Bytes of each id list, by an ordered aggregate over (list, position, id) rows."""
        out = [b""] * len(coded)
        for lo in range(0, len(coded), QUERY_WORDS):
            part = coded[lo:lo + QUERY_WORDS]
            size = np.array([len(x) for x in part])
            first = np.cumsum(size) - size
            t = np.fromiter((x for ids in part for x in ids), np.int64, int(size.sum()))
            self._fill("coded", {"w": pa.array(np.repeat(np.arange(lo, lo + len(part)), size)),
                                 "p": pa.array(np.arange(len(t)) - np.repeat(first, size)), "t": pa.array(t)})
            got = self.con.sql(DECODE).to_arrow_table()
            for k, x in zip(got["w"].to_pylist(), got["hex"].to_pylist()):
                out[k] = bytes.fromhex(x)
        return out

    def learn(self, chunks: list[str]) -> None:
        """Encode and decode new chunks into the cache: split, encode distinct words, join back.
        A chunk's entry is its ids as text, with the decoded bytes beside it only where they
        differ from the chunk's own bytes."""
        index: dict[str, int] = {}
        split = [[index.setdefault(w, len(index)) for w in self.words(c)] for c in chunks]
        ids = self.encode_words([w.encode() for w in index])
        raw = self.decode_words(ids)
        text = [" ".join(map(str, x)) for x in ids]
        for c, ws in zip(chunks, split):
            coded = " ".join([text[k] for k in ws])
            back = b"".join([raw[k] for k in ws])
            self.cache.put(c, coded if back == c.encode() else (coded, back))

    def encode_texts(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Per text its ids as text, joined by one space, and the decoded bytes."""
        cut = [text_chunks(x) for x in texts]
        need = set()
        for us in cut:
            need.update(us)
        self.learn(self.cache.missing(need))
        get = self.cache.young.__getitem__
        for x, us in zip(texts, cut):
            got = list(map(get, us))
            try:
                yield " ".join(got), x.encode()
            except TypeError:  # a chunk whose decoded bytes differ from its own
                yield (" ".join([g if isinstance(g, str) else g[0] for g in got]),
                       b"".join([u.encode() if isinstance(g, str) else g[1] for u, g in zip(us, got)]))
        self.cache.turn()


#: A space that follows white space, and the place between a word and the space that follows it.
INSIDE_RUN, AFTER_WORD = re.compile(r"\s "), re.compile(r"(?<=\S)(?= )")


def text_chunks(text: str) -> list[str]:
    """Cut a text before every space that follows a character other than white space, so that
    repeated chunks are split and encoded once. No match of the pattern holds white space after
    another character, so one always starts there; a run of white space, mixed or not, stays in
    one chunk with what follows it."""
    if not text:
        return []
    if "\0" in text or INSIDE_RUN.search(text):
        return AFTER_WORD.split(text)
    chunks = text.replace(" ", "\0 ").split("\0")
    return chunks if chunks[0] else chunks[1:]


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per Python worker process (workers are reused between tasks)."""
    claim("byte_bpe", _CODECS.clear)
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def bpe_round_trip(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Encode and decode every document: id count, hashes of the ids and of the decoded
    bytes, and whether decoding gave the text back."""
    def run(batches):
        c = codec(vocab_path, pattern)
        for b in slices(batches, "text"):
            texts = [x or "" for x in b.column("text").to_pylist()]
            n, hi, hd, ok = [], [], [], []
            for text, (ids, raw) in zip(texts, c.encode_texts(texts)):
                n.append(ids.count(" ") + 1 if ids else 0)
                hi.append(hashlib.sha256(ids.encode()).hexdigest())
                hd.append(hashlib.sha256(raw).hexdigest())
                ok.append(raw == text.encode())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(hi), pa.array(hd), pa.array(ok)],
                names=SCHEMA.names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, SCHEMA)


def encode(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every document."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        c = codec(vocab_path, pattern)
        for b in slices(batches, "text"):
            texts = [x or "" for x in b.column("text").to_pylist()]
            ids = [list(map(int, ids.split())) for ids, _ in c.encode_texts(texts)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=schema.names)

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, schema)


def decode(coded: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """(doc_id, data binary): the bytes of every id list; null ids give empty bytes."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("data", T.BinaryType())])

    def run(batches):
        c = codec(vocab_path, pattern)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                s = b.slice(lo, 256)
                raw = c.decode_words([x or [] for x in s.column("ids").to_pylist()])
                yield pa.RecordBatch.from_arrays([s.column("doc_id"), pa.array(raw, pa.binary())], names=schema.names)

    src = coded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return src.mapInArrow(run, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return bpe_round_trip(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
