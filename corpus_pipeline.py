"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, suffix-array dedup, best-fit packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.  All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martforge.llm import line_dedup, packing, quality, simhash, suffix
from martforge.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that match an earlier line; a document may be left with an empty text."""
    return line_dedup.remove_matches(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group stays: the one with the smallest doc_id."""
    return simhash.keep_one_of_each_group(docs, shingle=3, max_distance=2)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte windows that start in an earlier document, too."""
    return suffix.remove_repeats(docs, length=50)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as packed sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("best_fit_packing", best_fit_packing),
]

# SQL can express neither SimHash classes nor tokenizer ids; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
