"""The training-data pipeline: quality rules, near duplicates, benchmark passages, mixing, binary records.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last
return the columns of documents; the last one writes token-id records and returns what it reads back
from them. ``run`` writes each stage's rows and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tradewell.llm import decontaminate, jaccard, mixing, quality, records
from tradewell.session import materialise
from tradewell.sources.reader import read_columnar


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the compression bands that also pass the base rules."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8."""
    return jaccard.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a ten-word window of the benchmark."""
    return decontaminate.drop(docs, read_columnar(spark, f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def binary_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 read back from the record files."""
    return records.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixture", mixture), ("binary_records", binary_records)]

# SQL has neither zstandard nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_columnar(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
