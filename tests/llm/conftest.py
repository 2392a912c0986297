import random

import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"{name} string" for name in ("score", "start", "bucket", "chunk", "mark", "n", "a", "quality_score", "n_lines", "line")
)


def words(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n))


def frame(spark, rows):
    """Documents with extra columns whose names operators use inside."""
    full = [(i, t, "en", "s", len(t or ""), *["x"] * 10) for i, t in rows]
    return spark.createDataFrame(full, COLUMNS)


@pytest.fixture(scope="session")
def odd_rows():
    """Null ids, null, empty, blank, repeated, short, multi-byte and long texts, copies and near copies."""
    base, other = words(1, 120), words(2, 90)
    near = base.split(" ")
    near[60] = "changed"
    family = [(40 + k, " ".join(w if i != 7 * k + 3 else f"edit{k}" for i, w in enumerate(base.split(" ")))) for k in range(6)]
    return [
        (1, base), (2, other), (3, base), (4, " ".join(near)), (5, None), (6, ""), (7, " \n\t "), (8, "one two"),
        (9, "one two"), (10, "x" * 300), (11, "y" + "x" * 120), (12, "äöü ß 日本語 " * 20), (13, "z" + "äöü ß 日本語 " * 12),
        (14, words(3, 12_000)), (15, other.upper()), (16, other + "\n" + base[:200]), (17, "a"), (1, base), (18, base + "\n" + base),
        (None, base), (None, None), (19, "q\0w\r\n" + words(4, 30) + "\n\n" + words(4, 30)), (19, words(5, 40)), *family,
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).repartition(3, F.xxhash64("text")).persist()


@pytest.fixture(scope="session")
def no_documents(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows: frame(spark, rows)


@pytest.fixture(scope="session")
def tables(spark, sf):
    return {t: spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels", "benchmark", "pages")}
