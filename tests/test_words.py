from collections import Counter

from tarmac.checks.fixtures import documents
from tarmac.operators.words import count_directory, read_counts, word_count


def test_two_greetings(spark, tmp_path):
    source = tmp_path / "input"
    source.mkdir()
    (source / "file2.txt").write_text("Hello Docker\n")
    (source / "file1.txt").write_text("Hello Hadoop\n")
    count_directory(spark, str(source), str(tmp_path / "output"))
    assert [tuple(r) for r in read_counts(spark, str(tmp_path / "output")).orderBy("word").collect()] == [
        ("Docker", 1), ("Hadoop", 1), ("Hello", 2),
    ]
    lines = [line for p in sorted((tmp_path / "output").glob("part-*")) for line in p.read_text().splitlines()]
    assert lines == ["Docker\t1", "Hadoop\t1", "Hello\t2"]


def test_separators(spark):
    df = spark.createDataFrame([("  a\tb\n\na\r\fc d\x0be ",), ("",), (None,), ("   ",)], "value string")
    assert [tuple(r) for r in word_count(df).collect()] == [("a", 2), ("b", 1), ("c d\x0be", 1)]


def test_whole_texts_against_a_plain_count(spark, sf):
    docs = documents(spark, sf)
    expected = Counter()
    for row in docs.collect():
        expected.update(w for w in row["text"].translate(str.maketrans("\t\n\r\f", "    ")).split(" ") if w)
    counted = word_count(docs, "text").collect()
    assert {r["word"]: r["n"] for r in counted} == dict(expected)
    assert [r["word"].encode() for r in counted] == sorted(w.encode() for w in expected)
