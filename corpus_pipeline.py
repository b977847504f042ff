"""From raw documents to token ids: quality rules, near duplicates, repeated strings, benchmark leaks, BPE."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from yardline.llm import bpe, decontaminate, near_dup, quality_rules, suffix_dedup
from yardline.llm.queries import TOKENIZER
from yardline.llm.text import materialise, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go from the texts, documents that lose too much go altogether."""
    return quality_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (shingles of five words, similarity 0.8)."""
    return near_dup.drop_near_duplicates(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 100 that occur earlier go from the texts."""
    return suffix_dedup.drop_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with an item of the benchmark go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of ids and of the decoded text."""
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeats),
    ("benchmark_leaks", benchmark_leaks),
    ("bpe", token_ids),
]

#: BPE has no SQL form; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared scratch folder and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
