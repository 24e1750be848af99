"""Corpus pipeline: documents in, token files out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import ans_tokens, minhash_oph, mixing, qgram_leaks, quality_crf
from tierwise.llm.common import spill, table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the line field reject."""
    return quality_crf.keep(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (five-word shingles,
    similarity 0.8 or more)."""
    return minhash_oph.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark passage."""
    return qgram_leaks.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats documents towards equal shares of the sources and shuffles."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token files and returns what is read back from them."""
    return ans_tokens.tokens_of(docs, tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]

#: SQL can't express the trained field or the tokenizer
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
