"""Sampling and splitting, random or reproducible.

The random forms depend on how the input is partitioned, and the random split
sorts every partition first. The hash forms decide row by row from a key: no
sort, no dependence on partitioning, and the same answer when a lost task is
run again. Training therefore uses the hash forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tarmac.functions.columns import bucket_of_integer, bucket_of_row

# Multiplier, offset and modulus of the two bucket rules. The moduli
# are two primes: no stride of the keys falls into few buckets, the split of a
# sample stays unbiased, and fractions resolve to one in a million.
SAMPLE_RULE = (7919, 17, 1_000_003)
SPLIT_RULE = (104729, 11, 999_983)
SAMPLE_SEED = 7919
SPLIT_SEED = 104729


def sample_bernoulli(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    """Keep each row with probability ``fraction``, without replacement."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def split_random(df: DataFrame, fraction: float, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    first, second = df.randomSplit([fraction, 1.0 - fraction], seed=seed)
    return first, second


def _bucket(df: DataFrame, key: str | None, rule: tuple[int, int, int], seed: int) -> Column:
    """By the key; rows without one are spread by the whole row, so that they fall into all parts."""
    multiplier, offset, modulus = rule
    by_row = bucket_of_row([F.col(c) for c in df.columns], seed, modulus)
    if key is None:
        return by_row
    if dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        by_key = bucket_of_integer(F.col(key), multiplier, offset, modulus)
    else:
        by_key = bucket_of_row([F.col(key)], seed, modulus)
    return F.when(F.col(key).isNull(), by_row).otherwise(by_key)


def threshold(fraction: float, modulus: int) -> int:
    """Number of buckets that make up ``fraction``; a positive fraction gets one at least."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"not a fraction: {fraction}")
    return max(round(fraction * modulus), 1 if fraction > 0 else 0)


def sample_hash(df: DataFrame, fraction: float, key: str | None = None) -> DataFrame:
    """Keep about ``fraction`` of the rows, decided by ``key`` or by the whole row."""
    bucket = _bucket(df, key, SAMPLE_RULE, SAMPLE_SEED)
    return df.where(bucket < threshold(fraction, SAMPLE_RULE[2]))


def in_first_part(df: DataFrame, fraction: float, key: str | None = None) -> Column:
    """True for the rows of the first part of a hash split; never null."""
    return _bucket(df, key, SPLIT_RULE, SPLIT_SEED) < threshold(fraction, SPLIT_RULE[2])


def split_hash(df: DataFrame, fraction: float, key: str | None = None) -> tuple[DataFrame, DataFrame]:
    first = in_first_part(df, fraction, key)
    return df.where(first), df.where(~first)
