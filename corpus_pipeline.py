"""From raw documents to packed training sequences, one operator per stage.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read again as
the documents of the next one. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.llm import decontaminate, line_dedup, ngram_join, packing, quality
from tarmac.session import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold go."""
    return quality.keep_good(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand earlier, or nearly so, go; documents go if nothing visible is left of them."""
    left = line_dedup.clean(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in left.columns else left


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.keep_clean(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and their places in sequences."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", decontamination),
    ("packing", pack),
]

#: SQL can express neither the trained classifier nor the tokenizer; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
