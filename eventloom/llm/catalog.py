"""One query an operator: ``name -> (spark, folder) -> table``, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    byte_bpe,
    chosen_path,
    collocations,
    decision_list,
    decontaminate,
    html_text,
    language,
    resampling,
    secrets,
    token_files,
    toxicity,
    url_model,
    warc,
)
from eventloom.llm.common import id_remainder, table
from eventloom.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the URL contract.
URL_RULES = [
    url_model.UrlRule(True, "org", "/"),
    url_model.UrlRule(False, "example.org", "/es/"),
    url_model.UrlRule(False, "example.org", "/en/1"),
    url_model.UrlRule(True, "com", "/fr/"),
    url_model.UrlRule(False, "com", "/de/"),
]


def op1_ngram_join(spark, folder):
    return chosen_path.join(table(spark, folder, "documents"))


def op2_decontamination(spark, folder):
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.find_items(documents, benchmark, {"doc_id": F.col("doc_id")})


def op3_language_id(spark, folder):
    documents = table(spark, folder, "documents")
    held_out = id_remainder("doc_id", 3) == 1
    model = language.fit(documents.where(~held_out))
    return language.predict(documents, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op4_secret_scans(spark, folder):
    return secrets.scan_table(table(spark, folder, "documents"), {"doc_id": F.col("doc_id")})


def op5_token_files(spark, folder):
    return token_files.round_trip(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_warc(spark, folder):
    return warc.round_trip(table(spark, folder, "pages"))


def op7_toxicity(spark, folder):
    documents = table(spark, folder, "documents")
    held_out = id_remainder("doc_id", 5) == 0
    model = toxicity.fit(documents, table(spark, folder, "labels").where(~held_out))
    return toxicity.score(documents, model, {"doc_id": F.col("doc_id"), "held_out": held_out})


def op8_quality_rules(spark, folder):
    judged, _ = decision_list.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def op9_url_filters(spark, folder):
    return url_model.judge_urls(table(spark, folder, "pages"), URL_RULES)


def op10_byte_bpe(spark, folder):
    documents = table(spark, folder, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.round_trip(documents, path, public_tokenizers.PATTERN, {"doc_id": F.col("doc_id")})


def op11_importance_resampling(spark, folder):
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_collocations(spark, folder):
    return collocations.mine(table(spark, folder, "documents"))


def op13_html_text(spark, folder):
    return html_text.extract(table(spark, folder, "pages"))


QUERIES: dict[str, Query] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_secret_scans": op4_secret_scans,
    "op5_token_files": op5_token_files,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filters": op9_url_filters,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_collocations": op12_collocations,
    "op13_html_text": op13_html_text,
}
