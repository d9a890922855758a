"""Corpus preparation: language ID, near-duplicates, repeated passages, secrets, packing.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the
columns of ``documents``; the last returns the packed pieces with their token ids.

1. language ID: documents without a language (``und``: null text or no letters) go.
2. SimHash near-duplicates: of each group the document with the smallest id stays.
3. substring dedup: words of repeated passages go; documents that lose every word go.
4. secret scan: every secret is replaced by ``[secret]``.
5. packing: sequences of 1024 tokens in the corpus's own mixture of sources.

Null texts leave in stage 1; null ids, langs and sources pass through; an empty table gives an
empty result; repeated rows count as copies in stage 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import language_id, packing, secret_scan, simhash, substring_dedup
from vitrine.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(language_id.learning_rows(docs))
    out = language_id.identify(docs, model, carry=COLUMNS).where(F.col("lang_pred") != language_id.UNDETERMINED)
    return out.select("rest.*")


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(docs, shingle=3, max_bits=2)
    return simhash.one_of_each_group(docs.select(*COLUMNS), groups)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = tuple(c for c in COLUMNS if c != "text")  # the text itself goes to Python once only
    out = substring_dedup.remove_repeats(docs, carry=others).where("n_removed = 0 or n_removed < n_words")
    return out.select(*[F.col("kept").alias(c) if c == "text" else
                        F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("rest.n_chars")).alias(c) if c == "n_chars"
                        else F.col(f"rest.{c}").alias(c) for c in COLUMNS])


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs.select(*COLUMNS).withColumn("was", F.length("text")))
    return clean.withColumn("n_chars", F.when(F.length("text") != F.col("was"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop("was")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers as P

    return packing.pack(docs, P.path("byte_bpe_50k.json"), P.PATTERN)


STAGES = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_per_group),
    ("substring_dedup", without_repeats),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: SQL cannot express the language mixtures or the packing; tests check every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
