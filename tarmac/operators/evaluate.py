"""Row counts, accuracy and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.contract import FLIGHTS


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def accuracy(predictions: DataFrame, label: str = FLIGHTS.label, prediction: str = "prediction") -> DataFrame:
    """One row: rows, correct rows and their share, in one aggregation."""
    correct = F.count_if(F.col(prediction) == F.col(label))
    return predictions.agg(
        F.count("*").alias("n"),
        correct.alias("n_correct"),
        F.try_divide(correct, F.count("*")).alias("accuracy"),
    )


def preview_top(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows; in a fixed order if one is given."""
    return (df.orderBy(*order) if order else df).limit(n)
