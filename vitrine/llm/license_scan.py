"""Licence scan by diagonal voting.

Every text becomes words (ASCII letters in lower case), and every word position the rolling
hashes of the 2 and the 4 words that begin there. Spark joins them all to the positions of the
templates' word k-grams (k = 2 for phrases, 4 for notices), and a match is kept when its words
are equal, so hashes decide nothing. Matches vote for the diagonal (place in the document less
place in the template):

* a phrase is found where all its k-grams lie on one diagonal: the base places;
* of a notice, diagonals at most ``GAP`` words apart are merged, since an inserted or dropped
  word moves the rest to a neighbour; the merged span is verified by the share of the
  template's words that its equal k-grams cover, and kept from ``MIN_COVER`` on.

The template table is fixed and small, so the join needs no shuffle of the corpus: only matches
and one marker row a document are shuffled, and nothing of a document is ever gathered but the
distinct template places of one diagonal (at most the template's length).

Defined results: a null text is empty (no words, no places, score 0); repeated rows and repeated
or null ids each give their own row; long texts are cut into pieces of ``PIECE`` bytes that
overlap by three words, so a task holds little of them and loses no place; overlapping places
all count; the score is the largest share of a template found, 1 for a phrase; an empty table
gives an empty result; columns beside the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.llm.common import slices, table, written
from vitrine.llm.license_templates import NOTICES, PHRASES

PHRASE_K, NOTICE_K = 2, 4
#: Diagonals so far apart are still one copy of a notice; share of its words a copy must cover.
GAP, MIN_COVER = 3, 0.5
#: Bytes of text in a row of the hash table.
PIECE = 1 << 16
SEPARATOR = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]"

_NEXT_SEPARATOR = re.compile(SEPARATOR).search
_THREE_WORDS = re.compile(rb"(?:" + SEPARATOR + rb"*[^\x00-\x2f\x3a-\x60\x7b-\x7f]+){0,3}").match
_IS_WORD = np.array([re.match(SEPARATOR, bytes([b])) is None for b in range(256)])
_BASE, _INVERSE, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64)), np.uint64(0xD6E8FEB86659FD93)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse (kept per worker)."""
    if not _POWERS or len(_POWERS[0][0]) < n:
        size = max(n, 1 << 20)
        ups, downs = np.full(size, _BASE), np.full(size, _INVERSE)
        ups[0] = downs[0] = 1
        _POWERS[:] = [(np.cumprod(ups), np.cumprod(downs))]
    return _POWERS[0][0][:n], _POWERS[0][1][:n]


def pieces(text: bytes) -> list[tuple[bytes, int]]:
    """(bytes, own) in order: words that begin in the first ``own`` bytes belong to the piece;
    up to three words follow so that k-grams across the cut are whole."""
    if len(text) <= PIECE:
        return [(text, len(text))]
    out, at = [], 0
    while at < len(text):
        cut = _NEXT_SEPARATOR(text, min(at + PIECE, len(text)))
        end = cut.end() if cut else len(text)
        out.append((text[at:_THREE_WORDS(text, end).end()], end - at))
        at = end
    return out


class Words:
    """Words of a list of pieces: where they begin and end, their piece, and their hashes."""

    def __init__(self, parts: list[bytes]):
        raw = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
        word = _IS_WORD[raw]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        self.start, self.end = edge[::2], edge[1::2]
        self.origin = np.cumsum([1] + [len(p) + 1 for p in parts])
        self.piece = np.searchsorted(self.origin, self.start, side="right") - 1
        self.bytes = raw[word]
        up, down = _powers(len(raw))
        total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up)])
        h = (total[self.end] - total[self.start]) * down[self.start]
        h ^= h >> np.uint64(29)
        self.hash = h * np.uint64(0xBF58476D1CE4E5B9)

    def strings(self) -> pa.Array:
        ends = np.concatenate([[0], np.cumsum(self.end - self.start)]).astype(np.int32)
        return pa.StringArray.from_buffers(len(self.start), pa.py_buffer(ends), pa.py_buffer(self.bytes.tobytes()))

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rolling hash of the k words from each word on, and whether the piece has so many."""
        n = len(self.hash)
        out, whole = np.zeros(n, np.uint64), np.zeros(n, bool)
        if n >= k:
            rolled = self.hash[:n - k + 1].copy()
            for j in range(1, k):
                rolled = rolled * _STEP + self.hash[j:n - k + 1 + j]
            out[:n - k + 1] = rolled ^ (rolled >> np.uint64(32))
            whole[:n - k + 1] = self.piece[k - 1:] == self.piece[:n - k + 1]
        return out.view(np.int64), whole


HASHED = "rid long, doc_id long, n_words long, first long, words array<string>, h2 array<long>, h4 array<long>"


def gram_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every text: its words and, for each own word, both rolling hashes."""
    def run(batches):
        for b in slices(batches, "text", 1 << 20):
            parts = [(k, *p) for k, t in enumerate(b.column("text").cast(pa.binary()).to_pylist()) for p in pieces((t or b"").lower())]
            w = Words([p for _, p, _ in parts])
            n = len(parts)
            limit = w.origin[:n] + np.array([own for *_, own in parts])
            own = w.start < limit[w.piece] if len(w.start) else np.zeros(0, bool)
            held = np.bincount(w.piece, minlength=n)
            owned = np.bincount(w.piece[own], minlength=n)
            row = np.array([k for k, *_ in parts])
            per_row = np.bincount(row, weights=owned, minlength=b.num_rows).astype(np.int64)
            before = np.cumsum(owned) - owned
            first = before - before[np.searchsorted(row, row)]
            at = np.concatenate([[0], np.cumsum(owned)]).astype(np.int32)
            hashes = []
            for k in (PHRASE_K, NOTICE_K):
                h, whole = w.grams(k)
                hashes.append(pa.ListArray.from_arrays(pa.array(at), pa.array(h[own], mask=~whole[own])))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").take(take), b.column("doc_id").take(take), pa.array(per_row[row]), pa.array(first),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32)), w.strings()), *hashes],
                names=["rid", "doc_id", "n_words", "first", "words", "h2", "h4"])

    src = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, HASHED)


def template_words(phrases=PHRASES, notices=NOTICES) -> list[tuple[str, bool, int, list[str]]]:
    """(label, is phrase, k, words) of every template."""
    cut = lambda text: [w.decode() for w in re.split(SEPARATOR + rb"+", text.lower().encode()) if w]
    out = [(label, True, PHRASE_K, cut(t)) for label, t in phrases] + [(label, False, NOTICE_K, cut(t)) for label, t in notices]
    if any(len(w) < k for _, _, k, w in out):
        raise ValueError(f"a phrase needs {PHRASE_K} words and a notice {NOTICE_K}")
    return out


def _template_grams(spark: SparkSession, templates, k: int) -> DataFrame:
    """(hash, found): the templates' places that begin with the k-gram of this hash."""
    rows = []
    for t, (_, _, own, words) in enumerate(templates):
        if own == k:
            h, whole = Words([" ".join(words).encode()]).grams(k)
            rows += [(int(x), t, at, words[at:at + k]) for at, (x, ok) in enumerate(zip(h, whole)) if ok]
    return (spark.createDataFrame(rows, "hash long, t int, at int, gram array<string>")
            .groupBy("hash").agg(F.collect_list(F.struct("t", "at", "gram")).alias(f"found{k}")).withColumnRenamed("hash", f"t{k}"))


def matches(docs: DataFrame, templates, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, n_words, t, at, place): equal k-grams, and one row with t = -1 a document."""
    spark = docs.sparkSession
    none = F.array().cast("array<struct<t:int,at:int,gram:array<string>>>")
    places = (gram_hashes(docs, id_col, text_col).select("*", F.posexplode_outer("h2").alias("pos", "x2"))
              .withColumn("x4", F.expr("h4[pos]")).drop("h2", "h4"))
    for k in (PHRASE_K, NOTICE_K):  # the template tables are fixed: some hundred rows
        places = places.join(F.broadcast(_template_grams(spark, templates, k)), F.col(f"x{k}") == F.col(f"t{k}"), "left")
    is_first = (F.col("first") == 0) & (F.coalesce("pos", F.lit(0)) == 0)
    marker = F.array(F.struct(F.lit(-1).alias("t"), F.lit(0).alias("at"), F.lit(None).cast("array<string>").alias("gram")))
    found = F.concat(F.coalesce("found2", none), F.coalesce("found4", none), F.when(is_first, marker).otherwise(none))
    return (places.where(F.col("found2").isNotNull() | F.col("found4").isNotNull() | is_first)
            .select("rid", "doc_id", "n_words", "first", "pos", "words", F.explode(found).alias("m"))
            .where((F.col("m.t") < 0) | (F.slice("words", F.coalesce("pos", F.lit(0)) + 1, F.greatest(F.size("m.gram"), F.lit(0))) == F.col("m.gram")))
            .select("rid", "doc_id", "n_words", "m.t", "m.at", (F.col("first") + F.coalesce("pos", F.lit(0))).alias("place")))


def spans(found: DataFrame, templates) -> DataFrame:
    """(rid, t, label, is_phrase, start, stop, votes, cover) of the verified spans; ``stop`` is exclusive."""
    spark = found.sparkSession
    about = F.broadcast(spark.createDataFrame([(t, *x[:3], len(x[3])) for t, x in enumerate(templates)],
                                              "t int, label string, is_phrase boolean, k int, size int"))
    votes = (found.where("t >= 0").groupBy("rid", "t", (F.col("place") - F.col("at")).alias("diagonal"))
             .agg(F.collect_set("at").alias("ats")).join(about, "t"))
    cover = F.col("covered") / F.col("size")
    whole = (votes.where(F.col("is_phrase") & (F.size("ats") == F.col("size") - F.col("k") + 1))
             .select("rid", "t", "label", "is_phrase", F.col("diagonal").alias("start"), (F.col("diagonal") + F.col("size")).alias("stop"),
                     F.size("ats").cast("long").alias("votes"), F.lit(1.0).alias("cover")))
    by = Window.partitionBy("rid", "t").orderBy("diagonal")
    apart = F.when(F.col("diagonal") - F.lag("diagonal").over(by) <= GAP, 0).otherwise(1)
    merged = (votes.where(~F.col("is_phrase")).withColumn("apart", apart).withColumn("copy", F.sum("apart").over(by))
              .select("rid", "t", "label", "is_phrase", "size", "k", "copy", "diagonal", F.explode("ats").alias("at")))
    covered = (merged.select("*", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("k") - 1)).alias("word"))
               .groupBy("rid", "t", "copy", "word").agg(F.lit(1).alias("one")).groupBy("rid", "t", "copy").agg(F.count("one").alias("covered")))
    partly = (merged.groupBy("rid", "t", "label", "is_phrase", "size", "k", "copy")
              .agg(F.min(F.col("diagonal") + F.col("at")).alias("start"), F.max(F.col("diagonal") + F.col("at") + F.col("k")).alias("stop"), F.count(F.lit(1)).alias("votes"))
              .join(covered, ["rid", "t", "copy"]).withColumn("cover", cover).where(F.col("cover") >= MIN_COVER))
    return whole.unionByName(partly.select(*whole.columns))


def license_scan(docs: DataFrame, phrases=PHRASES, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, spans): rid, doc_id, n_words of every row, and the spans found in it by rid."""
    templates = template_words(phrases, notices)
    found = written(matches(docs, templates, id_col, text_col), "license-matches")
    return found.where("t < 0").select("rid", "doc_id", "n_words"), spans(found, templates)


def _labels(only=None):
    label = F.col("label") if only is None else F.when(only, F.col("label"))
    return F.array_join(F.array_sort(F.collect_set(label)), ",")


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, found = license_scan(table(spark, sf_dir, "documents"))
    base = F.col("is_phrase")
    per = found.groupBy("rid").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("start"))).alias("first_word"), F.max(F.when(base, F.col("start"))).alias("last_word"),
        _labels(base).alias("base_labels"), _labels().alias("labels"), F.max("cover").alias("score"))
    return docs.join(per, "rid", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))


def _values() -> str:
    rows = [f"({t}, '{label}', {str(phrase).lower()}, {k}, {words!r})" for t, (label, phrase, k, words) in enumerate(template_words())]
    return ",\n  ".join(rows)


#: The same rule on the words themselves, without hashes.
ORACLE_SQL = rf"""
WITH tpl(t, label, is_phrase, k, ws) AS (VALUES
  {_values()}),
g AS (SELECT t, k, spot, array_to_string(list_slice(ws, spot + 1, spot + k), ' ') AS gram
      FROM (SELECT t, k, ws, unnest(range(len(ws) - k + 1)) AS spot FROM tpl)),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
      FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM d),
n AS (SELECT rid, pos, word, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS e
      FROM w WINDOW o AS (PARTITION BY rid ORDER BY pos)),
m AS (SELECT rid, t, g.k, spot, pos - spot AS diagonal FROM n JOIN g ON g.k = 2 AND g.gram = n.word || ' ' || b
      UNION ALL
      SELECT rid, t, g.k, spot, pos - spot FROM n JOIN g ON g.k = 4 AND g.gram = n.word || ' ' || b || ' ' || c || ' ' || e),
phrases AS (SELECT rid, t, diagonal AS start, label FROM m JOIN tpl USING (t) WHERE is_phrase
            GROUP BY rid, t, diagonal, label, len(ws), tpl.k HAVING count(DISTINCT spot) = len(ws) - tpl.k + 1),
diagonals AS (SELECT DISTINCT rid, t, diagonal FROM m WHERE k = 4),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY rid, t ORDER BY diagonal) <= {GAP} THEN 0 ELSE 1 END AS apart FROM diagonals),
copies AS (SELECT *, sum(apart) OVER (PARTITION BY rid, t ORDER BY diagonal) AS copy FROM steps),
cover AS (SELECT rid, t, copy, count(DISTINCT word) AS covered
          FROM (SELECT rid, t, copy, unnest(range(spot, spot + k)) AS word FROM m JOIN copies USING (rid, t, diagonal)) GROUP BY ALL),
partly AS (SELECT rid, label, covered / len(ws) AS cover FROM cover JOIN tpl USING (t) WHERE covered / len(ws) >= {MIN_COVER}),
every AS (SELECT rid, label, start, 1.0::DOUBLE AS cover, true AS base FROM phrases
          UNION ALL SELECT rid, label, NULL, cover, false FROM partly),
per AS (SELECT rid, count(*) FILTER (WHERE base) AS n_base, min(start) AS first_word, max(start) AS last_word,
               string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels,
               string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score FROM every GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM d LEFT JOIN per USING (rid)
"""
