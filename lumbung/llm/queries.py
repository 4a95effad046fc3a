"""Registered queries of the subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lumbung.llm import (
    alignment,
    decontamination,
    fingerprint,
    language,
    minhash,
    pseudonyms,
    secrets,
    sentencepiece_codec,
    simhash,
    spelling,
    substring_dedup,
    suffix_dedup,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register
def op1_suffix_array_dedup(spark, sf_dir):
    return suffix_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


@register
def op7_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup(table(spark, sf_dir, "documents")).drop("kept")


@register
def op8_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("_id", "_th")


@register
def op6_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@register
def op10_document_fingerprints(spark, sf_dir):
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


@register
def op2_sentencepiece(spark, sf_dir):
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"))


@register
def op9_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op5_pii_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"))


@register
def op4_benchmark_decontamination(spark, sf_dir):
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op3_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


@register
def op11_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents"))


@register
def op12_cross_tokenizer_alignment(spark, sf_dir):
    return alignment.align(table(spark, sf_dir, "documents"))


@register
def op13_simhash_near_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))
