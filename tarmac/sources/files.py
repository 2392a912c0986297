"""Headered CSV and raw line files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# A line of a CSV may have so many fields; the parser sets aside a few bytes for each.
MAX_COLUMNS = 1_000_000

# No line holds this text, so that a CSV reader with it as its separator reads whole lines.
_NO_SEPARATOR = "\x01\x02\x01"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_columns: int = MAX_COLUMNS
) -> DataFrame:
    """A headered CSV with every column a string.

    Without a schema the names come from the first header, which costs one small job. The
    header of every file is checked against the names: a file with its columns in another
    order fails the job instead of being read by position. ``max_columns`` is the most
    fields of a line; a line with more fails the job, so raise it for wider ones.
    """
    reader = spark.read.option("header", True).option("maxColumns", max_columns)
    if schema is None:
        schema = reader.csv(path).schema
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A headered CSV; null and empty text are both written as an empty field."""
    df.write.option("header", True).option("emptyValue", "").csv(path)


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines at ``path`` without the first line of each file, whatever it says; empty lines are left out."""
    return _whole_lines(spark.read).csv(path)


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """``scan_lines`` as a stream of the files that are or appear at ``path``."""
    reader = _whole_lines(spark.readStream)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(path)


def _whole_lines(reader):
    return reader.schema("value string").option("header", True).option("sep", _NO_SEPARATOR).option("quote", "")


def to_lines(df: DataFrame) -> DataFrame:
    """Each row as one CSV line in a ``value`` column."""
    return df.select(F.to_csv(F.struct("*"), {"emptyValue": ""}).alias("value"))
