"""The registered queries of the training-data operators: thin digests over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martforge.llm import (bpe_count, debruijn, licenses, line_dedup, packing, phrases, quality, resampling, sentencepiece_codec, simhash, suffix,
                           token_store, vafile)
from martforge.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_distance=2)


@query
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), k=5, query_every=50)


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.report(table(spark, sf_dir, "documents"), length=50)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.report(table(spark, sf_dir, "documents"), length=20)


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_count.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.codec_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


@query
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
