"""Statistics of the label for the values of a categorical column, as an ordered feature.

A column with more labels than a forest has bins cannot be a categorical feature: the search for split points
would collect the square of the bins in one task. The mean of the target over a label's rows orders the labels
instead, and an ordered feature is cut at quantiles into any number of bins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from tarmac.contract import FLIGHTS, Contract
from tarmac.operators.encoding import Hot, find_hot, lookup
from tarmac.operators.vocabulary import MAX_SMALL_LABELS, Size
from tarmac.session import materialize

#: A training row's statistic comes from the other folds, so that its own target does not leak into it.
FOLDS = 5

#: A label's mean counts as if so many rows with the mean of all rows had been seen besides.
SMOOTHING = 20.0

# Stands between fold and label in a key; longer than any number and no part of one.
_SEP = "\x1f"


@dataclass(frozen=True)
class Statistics:
    """``table`` has ``field, label, fold, n, total``, fold -1 for all rows; ``prior`` is the mean of all rows."""

    table: DataFrame
    sizes: dict[str, Size]
    prior: float

    @property
    def columns(self) -> list[str]:
        return list(self.sizes)


def fold_of(df: DataFrame, folds: int = FOLDS) -> Column:
    """A row's fold: a hash of all its columns, the same whenever the row is computed again. Copies share a fold."""
    return F.pmod(F.xxhash64(F.lit("fold"), *[F.col(f"`{c}`") for c in df.columns]), F.lit(folds)).cast("int")


def fit_statistics(
    rows: DataFrame, columns: list[str], contract: Contract = FLIGHTS, folds: int = FOLDS
) -> Statistics:
    """Count rows and sum the target of every label and fold, all columns in one pass."""
    typed = rows.select(*columns, F.col(contract.label).cast("double").alias("target"), fold_of(rows, folds).alias("fold"))
    long = typed.unpivot(["fold", "target"], columns, "field", "label").where("label IS NOT NULL")
    sums = (F.count("*").alias("n"), F.sum("target").alias("total"))
    by_fold = materialize(long.groupBy("field", "label", "fold").agg(*sums), "fold-statistics")
    sums = (F.sum("n").alias("n"), F.sum("total").alias("total"))
    whole = by_fold.groupBy("field", "label").agg(*sums).withColumn("fold", F.lit(-1))
    table = materialize(by_fold.unionByName(whole), "statistics")
    return measured(table, columns)


def measured(table: DataFrame, columns: list[str]) -> Statistics:
    """Sizes and prior of a stored table."""
    whole = table.where("fold = -1").groupBy("field")
    found = whole.agg(
        F.count("*").alias("labels"), F.sum(F.octet_length("label")).alias("bytes"), F.sum("n").alias("n"), F.sum("total").alias("total")
    ).collect()
    rows = {r["field"]: r for r in found}
    n, total = sum(r["n"] for r in found), sum(r["total"] for r in found)
    none = Row(labels=0, bytes=0)
    sizes = {c: Size(rows.get(c, none)["labels"], rows.get(c, none)["bytes"]) for c in columns}
    return Statistics(table, sizes, total / n if n else 0.0)


def _mean(n: Column, total: Column, prior: float) -> Column:
    return (total + SMOOTHING * prior) / (n + SMOOTHING)


def with_statistics(
    rows: DataFrame,
    statistics: Statistics,
    contract: Contract = FLIGHTS,
    max_labels: int = MAX_SMALL_LABELS,
    hot: Hot | None = None,
) -> DataFrame:
    """Put a label's mean into the column's feature; unseen and null labels get the mean of all rows."""
    hot = find_hot(rows, statistics.sizes, max_labels) if hot is None else hot
    for column, size in statistics.sizes.items():
        output = contract.index_columns[column]
        whole = statistics.table.where((F.col("field") == column) & (F.col("fold") == -1))
        means = whole.select("label", _mean(F.col("n"), F.col("total"), statistics.prior).alias(output))
        rows = lookup(rows, means, column, output, size, hot)
        rows = rows.withColumn(output, F.coalesce(output, F.lit(statistics.prior)))
    return rows


def with_other_folds(
    rows: DataFrame,
    statistics: Statistics,
    contract: Contract = FLIGHTS,
    max_labels: int = MAX_SMALL_LABELS,
    folds: int = FOLDS,
) -> DataFrame:
    """As ``with_statistics``, for the rows the statistics were taken from: each without its own fold.

    Fold and label together are the key; hot keys are found for all columns in one pass.
    """
    columns, fold = rows.columns, fold_of(rows, folds).cast("string")
    keys = {c: f"_own_{i}" for i, c in enumerate(statistics.columns)}
    sizes = {keys[c]: Size(folds * s.labels, folds * (s.bytes + 2 * s.labels)) for c, s in statistics.sizes.items()}
    own = {key: F.when(F.col(f"`{c}`").isNotNull(), F.concat_ws(_SEP, fold, F.col(f"`{c}`"))) for c, key in keys.items()}
    rows = rows.withColumns(own)
    hot = find_hot(rows, sizes, max_labels)
    for column, key in keys.items():
        output = contract.index_columns[column]
        of_column = statistics.table.where(F.col("field") == column)
        whole = of_column.where("fold = -1").select("label", F.col("n").alias("all_n"), F.col("total").alias("all_total"))
        mean = _mean(F.col("all_n") - F.col("n"), F.col("all_total") - F.col("total"), statistics.prior)
        means = of_column.where("fold >= 0").join(whole, "label")
        means = means.select(F.concat_ws(_SEP, F.col("fold").cast("string"), "label").alias("label"), mean.alias(output))
        rows = lookup(rows, means, key, output, sizes[key], hot)
        rows = rows.withColumn(output, F.coalesce(output, F.lit(statistics.prior)))
    return rows.select(*[F.col(f"`{c}`") for c in columns], *[contract.index_columns[c] for c in statistics.columns])
