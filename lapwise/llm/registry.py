"""One registered query for each operator, over the whole table it is made for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.llm import curve_neighbours, hard_negatives, importance, jaccard_join, licenses, mixing, oracles, piece_lattice, pivot_search, quality_rules, sharding, suffix_dedup, token_files, whitening
from lapwise.session import tune


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return tune(spark).read.parquet(f"{folder}/documents.parquet")


def license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_documents(spark, folder))


def token_output(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_files.round_trip(_documents(spark, folder), tokenizer, end_id=2)


def quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.score(_documents(spark, folder))


def neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tune(spark).read.parquet(f"{folder}/embeddings.parquet")
    return curve_neighbours.search(vectors, query_step=20, k=20)


def mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_documents(spark, folder), weights=(1, 2, 3), max_repeat=3)


def importance_weights(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return importance.resample(_documents(spark, folder), labels)


def jaccard_links(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.join(_documents(spark, folder))


def suffix_dedup_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(_documents(spark, folder))


def shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(_documents(spark, folder), shards=40)


def pieces(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return piece_lattice.round_trip(_documents(spark, folder), model)


def whitened(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tune(spark).read.parquet(f"{folder}/embeddings.parquet")
    return whitening.whiten(vectors, components=16, scale=64, shift=1_000_000)


def exact_top(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tune(spark).read.parquet(f"{folder}/embeddings.parquet")
    return pivot_search.search(vectors, query_step=50, k=5, scale=256)


def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = tune(spark).read.parquet(f"{folder}/embeddings.parquet")

    def moved(vec_id: Column, label: Column) -> Column:
        return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)

    return hard_negatives.mine(vectors, anchor_step=100, positives=5, negatives=10, relabel=moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scans": license_scans,
    "op2_token_output": token_output,
    "op3_quality_rules": quality,
    "op4_curve_neighbours": neighbours,
    "op5_mixing_sources": mixed_sources,
    "op6_importance_resampling": importance_weights,
    "op7_ngram_jaccard_join": jaccard_links,
    "op8_suffix_array_dedup": suffix_dedup_bytes,
    "op9_sharding": shards,
    "op10_sentencepiece": pieces,
    "op11_whitening": whitened,
    "op12_pivot_search": exact_top,
    "op13_hard_negatives": mined_negatives,
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scans": licenses.reference_sql(),
    "op7_ngram_jaccard_join": oracles.JACCARD_LINKS,
    "op8_suffix_array_dedup": oracles.REPEATED_BYTES,
    "op9_sharding": oracles.SHARDS,
    "op12_pivot_search": oracles.HIGHEST_PRODUCTS,
    "op13_hard_negatives": oracles.HARD_NEGATIVES,
}
