"""Vocabularies: the labels of each categorical column, numbered by frequency."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tarmac.contract import FLIGHTS, Contract
from tarmac.session import materialize

# Up to this many labels a vocabulary is ranked in one task per column,
# broadcast, or brought to the driver; past it the distributed forms apply.
MAX_SMALL_LABELS = 1_000_000
MAX_SMALL_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    labels: int
    bytes: int

    def small(self, max_labels: int = MAX_SMALL_LABELS, max_bytes: int = MAX_SMALL_BYTES) -> bool:
        return self.labels <= max_labels and self.bytes <= max_bytes


@dataclass(frozen=True)
class Vocabulary:
    """``table`` has columns ``field, label, n, idx``; ``sizes`` is measured per column."""

    table: DataFrame
    sizes: dict[str, Size]

    def of(self, column: str) -> DataFrame:
        return self.table.where(F.col("field") == column).select("label", "n", "idx")

    def largest(self) -> int:
        return max((size.labels for size in self.sizes.values()), default=0)


class VocabularyTooLarge(ValueError):
    """A vocabulary is too large for the form asked for; the message names another."""


def count_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    """Occurrences of every non-null label, all columns in one pass.

    The rows are unpivoted ahead of one aggregation, whose map side reduces each
    task's rows to one per label before anything is shuffled.
    """
    long = df.unpivot([], columns, "field", "label")
    return long.where(F.col("label").isNotNull()).groupBy("field", "label").agg(F.count("*").alias("n"))


def measure(labels: DataFrame, columns: list[str]) -> dict[str, Size]:
    """Number and total byte length of the labels of each column."""
    rows = (
        labels.groupBy("field")
        .agg(F.count("*").alias("labels"), F.sum(F.octet_length("label")).alias("bytes"))
        .collect()
    )
    found = {r["field"]: Size(r["labels"], r["bytes"]) for r in rows}
    return {c: found.get(c, Size(0, 0)) for c in columns}


def _rank_small(counts: DataFrame) -> DataFrame:
    order = Window.partitionBy("field").orderBy(F.desc("n"), "label")
    return counts.withColumn("idx", (F.row_number().over(order) - 1).cast("double"))


def _rank_large(counts: DataFrame) -> DataFrame:
    """The same numbering without bringing a column's labels to one task.

    Range partitioning puts the labels in global order; a label's number is its
    place in its own range plus the sizes of the ranges before it. Only those
    sizes, one row per range and column, are broadcast.
    """
    ranges = materialize(
        counts.repartitionByRange("field", F.desc("n"), "label").withColumn("range", F.spark_partition_id()),
        "label-ranges",
    )
    before = Window.partitionBy("field").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranges.groupBy("field", "range")
        .agg(F.count("*").alias("size"))
        .select("field", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    place = Window.partitionBy("field", "range").orderBy(F.desc("n"), "label")
    return (
        ranges.withColumn("place", F.row_number().over(place) - 1)
        .join(F.broadcast(offsets), ["field", "range"])
        .select("field", "label", "n", (F.col("offset") + F.col("place")).cast("double").alias("idx"))
    )


def rank_labels(counts: DataFrame, sizes: dict[str, Size], max_labels: int = MAX_SMALL_LABELS) -> DataFrame:
    """Number each column's labels from 0, most frequent first, ties by label."""
    if all(size.small(max_labels) for size in sizes.values()):
        return _rank_small(counts)
    return _rank_large(counts)


def fit_vocabulary(
    df: DataFrame,
    columns: list[str] | None = None,
    contract: Contract = FLIGHTS,
    max_labels: int = MAX_SMALL_LABELS,
) -> Vocabulary:
    """Count, measure and number the labels of ``columns``; reads ``df`` once."""
    columns = columns or contract.categorical
    counts = materialize(count_labels(df, columns), "label-counts")
    sizes = measure(counts, columns)
    ranked = materialize(rank_labels(counts, sizes, max_labels), "vocabulary")
    return Vocabulary(ranked, sizes)


def to_indexers(
    vocabulary: Vocabulary,
    contract: Contract = FLIGHTS,
    handle_invalid: str = "error",
    max_labels: int = MAX_SMALL_LABELS,
) -> list[StringIndexerModel]:
    """One fitted indexer per categorical column, in the contract's order.

    Their labels live on the driver, so their measured size is checked first. Single-column
    models, because one model over label lists of unequal length pads the short ones.
    """
    for column in contract.categorical:
        if not vocabulary.sizes[column].small(max_labels):
            raise VocabularyTooLarge(
                f"{column} has {vocabulary.sizes[column].labels} labels; "
                "encode it with tarmac.operators.encoding.encode_join"
            )
    rows = (
        vocabulary.table.where(F.col("field").isin(contract.categorical))
        .groupBy("field")
        .agg(F.sort_array(F.collect_list(F.struct("idx", "label"))).alias("ordered"))
        .collect()
    )
    labels = {r["field"]: [e["label"] for e in r["ordered"]] for r in rows}
    return [
        StringIndexerModel.from_labels(
            labels.get(column, []), inputCol=column, outputCol=output, handleInvalid=handle_invalid
        )
        for column, output in contract.index_columns.items()
    ]


def from_indexers(spark: SparkSession, indexers: list[StringIndexerModel]) -> DataFrame:
    """``field, label, idx`` of fitted single-column indexers, as a table."""
    rows = [
        (indexer.getInputCol(), label, float(i)) for indexer in indexers for i, label in enumerate(indexer.labels)
    ]
    return spark.createDataFrame(rows, "field string, label string, idx double")
