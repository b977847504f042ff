"""One query for each operator, over its whole table, and the SQL that says the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from yardline.llm import (
    bpe,
    chat_format,
    decontaminate,
    html_text,
    merkle,
    near_dup,
    quality_knn,
    quality_rules,
    secret_spans,
    suffix_dedup,
    token_files,
    warc,
    whitening,
)
from yardline.llm.oracles import ORACLES
from yardline.llm.text import read_table

__all__ = ["ORACLES", "QUERIES", "TOKENIZER"]

TOKENIZER = "byte_bpe_50k.json"


def op1_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.main_text(read_table(spark, folder, "pages"))


def op2_quality_knn(spark: SparkSession, folder: str) -> DataFrame:
    return quality_knn.score_quality(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op3_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return chat_format.format_chats(read_table(spark, folder, "conversations"))


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, folder, "documents"), words=2)


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.overlaps(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality_rules.score_rules(read_table(spark, folder, "documents").select("doc_id", "text"))
    return scored.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_failed_lines", "lost_chars",
    )


def op7_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = read_table(spark, folder, "pages")
    return warc.write_and_read(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    found = suffix_dedup.remove_repeats(docs)
    return found.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), with_ids=False)


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return token_files.with_checksums(token_files.write_and_read(docs, public_tokenizers.path(TOKENIZER)))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))


def op12_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_spans.digests(secret_spans.find_secrets(read_table(spark, folder, "documents")))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return merkle.tampered_proofs(docs, ["doc_id", "source", "lang", "n_chars", "text"])


QUERIES = {
    "op1_html_text": op1_html_text,
    "op2_quality_knn": op2_quality_knn,
    "op3_chat_format": op3_chat_format,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_decontamination": op5_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_warc": op7_warc,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_bpe": op9_bpe,
    "op10_token_files": op10_token_files,
    "op11_whitening": op11_whitening,
    "op12_secret_spans": op12_secret_spans,
    "op13_merkle_manifest": op13_merkle_manifest,
}
