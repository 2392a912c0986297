"""The registered queries of this package: each operator over its whole table, as its contract returns it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import (
    conversations, decontaminate, fingerprint, language, licenses, line_dedup, manifest, ngram_join, packing, quality,
    substring_dedup, toxicity, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return toxicity.score(documents, toxicity.train(documents, labels))


@query
def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = _table(spark, sf, "documents"), _table(spark, sf, "labels")
    return quality.digest(documents, quality.train(documents, labels))


@query
def op3_language(spark: SparkSession, sf: str) -> DataFrame:
    documents = _table(spark, sf, "documents")
    return language.predict(documents, language.train(documents))


@query
def op6_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf, "pages"))


@query
def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.digest(_table(spark, sf, "documents"))


@query
def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.decisions(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@query
def op10_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.digest(_table(spark, sf, "documents"))


@query
def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return substring_dedup.digest(_table(spark, sf, "documents"))


@query
def op7_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicate_groups(_table(spark, sf, "documents"))


@query
def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.digest(_table(spark, sf, "documents"))


@query
def op11_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.digest(_table(spark, sf, "documents"))


@query
def op12_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.digest(_table(spark, sf, "documents"))


@query
def op13_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.digest(_table(spark, sf, "conversations"))
