"""Column expressions: lenient casts, null tests and reproducible buckets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def lenient(column: Column, type_name: str) -> Column:
    """``column`` as ``type_name``; text that is no such value becomes null.

    A plain cast would fail the job on bad text, because Spark 4 is ANSI by default.
    """
    return column if type_name == "string" else column.try_cast(type_name)


def usable(name: str, type_name: str) -> Column:
    """True where a value can enter a feature vector: not null, not NaN and not infinite."""
    present = F.col(name).isNotNull()
    if type_name in ("double", "float"):
        infinity = F.lit(float("inf")).cast(type_name)  # NaN is the largest value of all
        return present & (F.col(name) < infinity) & (F.col(name) > -infinity)
    return present


def all_usable(columns: Iterable[tuple[str, str]]) -> Column:
    condition = F.lit(True)
    for name, type_name in columns:
        condition = condition & usable(name, type_name)
    return condition


def bucket_of_integer(key: Column, multiplier: int, offset: int, modulus: int) -> Column:
    """Bucket of an integer key of any width in ``[0, modulus)`` by a linear congruence; null for a null key.

    The key is reduced first, so that large keys cannot overflow; the residue is the same.
    """
    reduced = F.pmod(key.cast("bigint"), F.lit(modulus))
    return F.pmod(reduced * multiplier + offset, F.lit(modulus))


def bucket_of_row(columns: Iterable[Column], seed: int, modulus: int) -> Column:
    """Bucket of a whole row in ``[0, modulus)``; equal rows share a bucket."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(modulus))
