"""Word count over text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the characters that separate words.
SEPARATORS = r"[ \t\n\r\f]+"


def words(df: DataFrame, text: str = "value") -> DataFrame:
    """One row per word of the whole text."""
    return df.select(F.explode(F.split(F.col(text), SEPARATORS)).alias("word")).where(F.col("word") != "")


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """Occurrences of each word, ordered by word."""
    return words(df, text).groupBy("word").agg(F.count("*").alias("n")).orderBy("word")


def count_directory(spark: SparkSession, source: str, target: str) -> None:
    """Count the words of a directory of text files into sorted ``word<TAB>count`` lines."""
    counted = word_count(spark.read.text(source))
    counted.select(F.concat_ws("\t", "word", F.col("n").cast("string")).alias("value")).write.text(target)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Read ``word<TAB>count`` lines back."""
    cut = spark.read.text(path).select(F.split("value", "\t").alias("_parts"))
    return cut.select(
        F.get("_parts", F.lit(0)).alias("word"),
        F.get("_parts", F.lit(1)).cast("bigint").alias("n"),
    )
