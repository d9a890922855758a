"""Language identification by multilingual mixture inference.

Learning counts letter trigrams (each letter with its neighbours, hashed to a fixed number of
buckets) by language over all learning rows; every partition sends dense count blocks, summed
per (language, block). The model's size is languages x buckets, whatever the corpus.

A document is a mixture of languages and each of its words comes from one of them. From the
words' trigram likelihoods expectation-maximisation estimates the language proportions; the
language set then loses its weakest language, with the proportions estimated anew, as long as
the likelihood penalised by ``penalty * log(words) / 2`` per language does not fall. The
prediction is the largest proportion of the set that is left.

Defined results: a text that is null or has no letter is ``und`` with score 0 (so is every text
if nothing could be learned); a null doc_id is never learned from and counts as held out; a
null lang is never learned from; ties go to the language first in alphabetical order; repeated
rows give repeated result rows; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm.common import claim, crc32_mod, slices, table

BUCKETS = 1 << 16
BLOCK = 1 << 12
SMOOTHING = 0.05
ROUNDS = 12
PENALTY = 1.0
FOLDS = 5
UNDETERMINED = "und"
#: Text bytes handled at a time by one task.
SLICE = 1 << 19

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters (computed once per worker)."""
    if not _LETTERS:
        _LETTERS.append(np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)]))
    return _LETTERS[0]


def letter_trigrams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every letter, first letter of every word, document of every word)."""
    low = [x.lower() if x else "" for x in texts]
    ends = np.cumsum([len(x) + 1 for x in low])
    points = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le"), np.uint32)
    is_letter = _letters()[points]
    code = np.where(is_letter, points, 32).astype(np.uint64)
    at = np.flatnonzero(is_letter)
    h = code[at - 1] * np.uint64(0x9E3779B97F4A7C15) + code[at] * np.uint64(0xC2B2AE3D27D4EB4F) + code[at + 1] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(32)
    bucket = ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)
    first = np.flatnonzero(~is_letter[at - 1])
    doc = np.searchsorted(ends, at[first] - 1, side="right")
    return bucket, first, doc


@dataclass
class LanguageModel:
    """Log-likelihood of every trigram bucket by language."""

    langs: list[str]
    logs: np.ndarray  # buckets x languages, float32

    @classmethod
    def of(cls, counts: dict[str, np.ndarray]) -> LanguageModel:
        langs = sorted(counts)
        if not langs:
            return cls([], np.zeros((BUCKETS, 0), np.float32))
        c = np.stack([counts[x] for x in langs], axis=1).astype(np.float64)
        return cls(langs, np.log((c + SMOOTHING) / (c.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32))


def trigram_counts(rows: DataFrame) -> DataFrame:
    """(lang, block, counts): letter trigrams of the rows (text, lang), summed."""
    def count(batches):
        claim("language_id")
        held: dict[str, np.ndarray] = {}
        for b in slices(batches, "text", SLICE):
            langs = b.column("lang").to_pylist()
            texts = b.column("text").to_pylist()
            for lang in set(langs):
                bucket, _, _ = letter_trigrams([t for t, x in zip(texts, langs) if x == lang])
                if lang not in held:
                    held[lang] = np.zeros(BUCKETS, np.int64)
                held[lang] += np.bincount(bucket, minlength=BUCKETS)
        for lang, c in held.items():
            yield rows_of([(lang, k, c[k * BLOCK:(k + 1) * BLOCK]) for k in range(BUCKETS // BLOCK)])

    def merge(batches):
        name, total = None, None
        for b in batches:
            for lang, k, c in zip(*(b.column(x).to_pylist() for x in ("lang", "block", "counts"))):
                c = np.frombuffer(c, np.int64)
                if (lang, k) == name:
                    total += c
                else:
                    if name is not None:
                        yield rows_of([(*name, total)])
                    name, total = (lang, k), c.copy()
        if name is not None:
            yield rows_of([(*name, total)])

    def rows_of(rows):
        lang, k, c = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(k, pa.int32()), pa.array([x.tobytes() for x in c], pa.binary())],
                                          names=["lang", "block", "counts"])

    shape = "lang string, block int, counts binary"
    return (rows.mapInArrow(count, shape).repartition("lang", "block").sortWithinPartitions("lang", "block")
            .mapInArrow(merge, shape))


def learn(rows: DataFrame) -> LanguageModel:
    """The model of all rows (text, lang) with neither null."""
    counts: dict[str, np.ndarray] = {}
    for r in trigram_counts(rows.where("text is not null and lang is not null")).collect():
        c = counts.setdefault(r["lang"], np.zeros(BUCKETS, np.int64))
        c[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.int64)
    return LanguageModel.of({k: c for k, c in counts.items() if c.any()})


def _mixtures(like, top, doc, first, n, allowed, rounds):
    """Proportions by EM, and log-likelihoods, of documents over the allowed languages.
    ``like``: word likelihoods divided by each word's largest, whose log is ``top``."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        joint = like * share[doc]
        joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)
        share = np.add.reduceat(joint, first, axis=0) / n[:, None]
        share = np.where(allowed, np.maximum(share, 1e-12), 0.0)
        share /= share.sum(axis=1, keepdims=True)
    total = np.log(np.maximum((like * share[doc]).sum(axis=1), 1e-300)) + top
    return share, np.add.reduceat(total, first)


def infer(texts: list, model: LanguageModel, rounds: int = ROUNDS, penalty: float = PENALTY) -> np.ndarray:
    """Language proportions of each text (rows of zeros: undetermined)."""
    out = np.zeros((len(texts), len(model.langs)))
    bucket, word, doc = letter_trigrams(texts)
    if not len(word) or not model.langs:
        return out
    logs = np.add.reduceat(model.logs[bucket], word, axis=0).astype(np.float64)
    top = logs.max(axis=1)
    like = np.exp(logs - top[:, None])
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    n = np.diff(np.r_[first, len(doc)])
    some = doc[first]
    doc = np.repeat(np.arange(len(some)), n)
    cost = penalty * np.log(np.maximum(n, 2)) / 2
    allowed = np.ones((len(some), len(model.langs)), bool)
    share, fit = _mixtures(like, top, doc, first, n, allowed, rounds)
    weak = (share * n[:, None] < 0.5) & (share < share.max(axis=1, keepdims=True))  # less than half a word
    allowed &= ~weak
    share, fit = _mixtures(like, top, doc, first, n, allowed, rounds)
    open_ = allowed.sum(axis=1) > 1
    while open_.any():
        # documents that may still lose a language, with their words packed together
        d = np.flatnonzero(open_)
        words = np.flatnonzero(open_[doc])
        sub_first = np.cumsum(n[d]) - n[d]
        sub_doc = np.repeat(np.arange(len(d)), n[d])
        tried = allowed[d].copy()
        tried[np.arange(len(d)), np.where(tried, share[d], np.inf).argmin(axis=1)] = False
        s, f = _mixtures(like[words], top[words], sub_doc, sub_first, n[d], tried, rounds)
        better = f + cost[d] >= fit[d]
        allowed[d[better]], share[d[better]], fit[d[better]] = tried[better], s[better], f[better]
        open_[d] = better & (tried.sum(axis=1) > 1)
    out[some] = share
    return out


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, mix) of every row; ``mix``: proportions of the language set.
    With ``carry`` those columns of the document follow in the struct ``rest``."""
    others = [c for c in carry if c != text_col]  # the text itself goes to Python once only
    rest = F.struct(*others) if others else F.lit(None).cast("int")
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logs.tobytes()))

    def run(batches):
        claim("language_id")
        langs, raw = shared.value
        m = LanguageModel(langs, np.frombuffer(raw, np.float32).reshape(BUCKETS, len(langs)))
        for b in slices(batches, "text", SLICE):
            share = infer(b.column("text").to_pylist(), m)
            known = share.any(axis=1)
            best = share.argmax(axis=1) if langs else np.zeros(len(share), int)
            pred = [langs[k] if ok else UNDETERMINED for k, ok in zip(best, known)]
            score = [min(1.0, float(x[k])) if ok else 0.0 for x, k, ok in zip(share, best, known)]
            mix = [[(langs[k], float(x[k])) for k in np.flatnonzero(x > 0)] for x in share]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                 pa.array(mix, pa.map_(pa.string(), pa.float64())), b.column("rest"), *([b.column("text")] if carry else [])],
                names=["doc_id", "lang_pred", "score", "mix", "rest", *(["text"] if carry else [])])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), rest.alias("rest"))
    kind = src.schema["rest"].dataType.simpleString()
    out = src.mapInArrow(run, f"doc_id long, lang_pred string, score double, mix map<string,double>, rest {kind}" + (", text string" if carry else ""))
    if not carry:
        return out.drop("rest")
    back = F.struct(*[F.col("text").alias(c) if c == text_col else F.col(f"rest.{c}").alias(c) for c in carry])
    return out.withColumn("rest", back).drop("text")


def learning_rows(docs: DataFrame) -> DataFrame:
    """(text, lang) of the documents outside the held-out fold."""
    return docs.where(crc32_mod("doc_id", FOLDS) != 0).select(F.col("text").cast("string"), F.col("lang").cast("string"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, learn(learning_rows(docs)))
    held = F.coalesce(crc32_mod("doc_id", FOLDS) == 0, F.lit(True))
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score", "mix")
