"""Named queries of the training-data operators, each over its whole table,
with its DuckDB oracle where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import (
    ans_tokens,
    block_search,
    byte_bpe,
    chat_trees,
    html_density,
    lang_crf,
    license_join,
    minhash_oph,
    mixing,
    prefix_trie,
    qgram_leaks,
    quality_crf,
    url_templates,
)
from tierwise.llm.common import table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query("op1_license_scan", license_join.oracle())
def op1(spark, sf_dir):
    return license_join.scan(table(spark, sf_dir, "documents"))


@query("op2_source_mixing", mixing.ORACLE)
def op2(spark, sf_dir):
    mixed = mixing.store(table(spark, sf_dir, "documents"))
    return mixed.select("doc.doc_id", "doc.source", "copies", "copy_no", "shuffle_key").orderBy("shuffle_key", "doc_id")


@query("op3_quality_rules")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality_crf.score(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


@query("op4_html_extraction")
def op4(spark, sf_dir):
    return html_density.extract(table(spark, sf_dir, "pages"))


@query("op5_decontamination")
def op5(spark, sf_dir):
    return qgram_leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_minhash_dedup")
def op6(spark, sf_dir):
    return minhash_oph.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return lang_crf.predict(docs, lang_crf.train(docs))


@query("op8_url_filter", url_templates.oracle())
def op8(spark, sf_dir):
    return url_templates.judge(table(spark, sf_dir, "pages"))


@query("op9_chat_formatting", chat_trees.ORACLE)
def op9(spark, sf_dir):
    return chat_trees.format_conversations(table(spark, sf_dir, "conversations"))


@query("op10_token_ids")
def op10(spark, sf_dir):
    return ans_tokens.tokens_of(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op11_byte_bpe")
def op11(spark, sf_dir):
    import public_tokenizers

    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op12_block_search", block_search.ORACLE)
def op12(spark, sf_dir):
    return block_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op13_prefix_trie")
def op13(spark, sf_dir):
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
