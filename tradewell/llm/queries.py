"""Registered queries of the training-data operators: each reads its whole table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewell.llm import (attention_lm, chat, decontaminate, exact_dedup, hard_negatives, jaccard, language, lexical_search,
                           mixing, oracles, quality, records, suffix_dedup, token_count)
from tradewell.llm.common import held_out
from tradewell.sources.reader import read_columnar

VOCABULARY = "word_bpe_49k.json"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_columnar(spark, f"{sf_dir}/documents.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = held_out("doc_id", 4, 2)
    return language.predict(docs, language.learn(docs.where(~held)), held)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(documents(spark, sf_dir), read_columnar(spark, f"{sf_dir}/benchmark.parquet"))


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = read_columnar(spark, f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], said.schema)
    return chat.digest(chat.format_conversations(said.union(extra)))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(documents(spark, sf_dir), shingle_words=4, threshold=(85, 100))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score(documents(spark, sf_dir), held_out("doc_id", 5, 1),
                              public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_binary_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), end_id=2)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.digest(documents(spark, sf_dir))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(read_columnar(spark, f"{sf_dir}/embeddings.parquet"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(documents(spark, sf_dir), read_columnar(spark, f"{sf_dir}/benchmark.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [op1_quality_rules, op2_suffix_array_dedup, op3_language_id, op4_decontamination, op5_chat_formatting,
            op6_ngram_jaccard_join, op7_lm_scoring, op8_binary_records, op9_mixing, op10_token_counts,
            op11_exact_dedup, op12_hard_negatives, op13_lexical_search, pipeline]
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
