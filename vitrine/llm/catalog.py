"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitrine.llm.byte_bpe import op2_byte_bpe
from vitrine.llm.html_extract import op9_html_extract
from vitrine.llm.language_id import op4_language_id
from vitrine.llm.lm_score import op3_lm_score
from vitrine.llm.packing import op5_packing
from vitrine.llm.secret_scan import op1_secret_scan
from vitrine.llm.simhash import op7_simhash
from vitrine.llm import embedding_dedup, filter_audit, license_scan, substring_dedup, topk_search, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_lm_score": op3_lm_score,
    "op4_language_id": op4_language_id,
    "op5_packing": op5_packing,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_simhash": op7_simhash,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_html_extract": op9_html_extract,
    "op10_topk_search": topk_search.op10_topk_search,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_whitening": whitening.op12_whitening,
    "op13_license_scan": license_scan.op13_license_scan,
}

#: The others need a tokenizer, a model, other hashes, eigenvectors or a learned threshold.
ORACLE: dict[str, str] = {
    "op6_substring_dedup": substring_dedup.ORACLE_SQL,
    "op8_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op10_topk_search": topk_search.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
    "op13_license_scan": license_scan.ORACLE_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
