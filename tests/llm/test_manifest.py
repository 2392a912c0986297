import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tarmac.llm import manifest
from tarmac.llm.oracle import ORACLE

SCHEMA = "tree string, doc_id bigint, source string, lang string, n_chars bigint, text string, rank int, Size string, kids map<string,int>"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels(hashes):
    found = [hashes]
    while len(found[-1]) > 1:
        found.append([sha("".join(found[-1][i : i + 16])) for i in range(0, len(found[-1]), 16)])
    return found


def steps(tree, i):
    for level in tree[:-1]:
        run = i // 16 * 16
        yield "".join(level[run:i]), "".join(level[i + 1 : run + 16])
        i //= 16


def brute(rows):
    """The contract, row by row, for ``doc_id, source, lang, n_chars, text``."""
    sources = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        leaf = sha("".join(map(field, (doc_id, source, lang, n_chars, text))))
        other = sha("".join(map(field, (doc_id, source, lang, n_chars, lowered(text)))))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        sources[source].append(((doc_id is not None, doc_id or 0, leaf), doc_id, leaf, other if tampered else leaf))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        sources[source].sort(key=lambda r: r[0])
        trees[source] = levels([leaf for _, _, leaf, _ in sources[source]])
    top = levels([trees[source][-1][0] for source in order])
    for place, source in enumerate(order):
        for i, (_, doc_id, leaf, at_hand) in enumerate(sources[source]):
            path = [*steps(trees[source], i), *steps(top, place)]
            for before, after in path:
                at_hand = sha(before + at_hand + after)
            root = top[-1][0]
            proof = sha("".join(b + a for b, a in path))
            yield doc_id, leaf, trees[source][-1][0], root, proof, at_hand, at_hand == root


def check(documents, rows):
    found = manifest.digest(documents)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(brute(rows), key=repr)


@pytest.fixture(scope="module")
def odd_leaves():
    """Null ids, sources and texts, single leaves, full and nearly full runs, ties, repeats and a long text."""
    rows = [(i, "hot", "en", 3, f"Text {i}") for i in range(1000, 1000 + 4113)]
    rows += [(i, "run", None, None, f"T{i}") for i in range(16)] + [(i, "run1", "x", 0, "") for i in range(17)]
    rows += [(i, f"s{i}", "x", 0, "LONE") for i in range(40)] + [(7, "é", "x", 1, "Ü A"), (7, "Z", "x", 1, "Z")]
    rows += [(None, "hot", "en", 1, f"No id {i}") for i in range(5)] + [(9, None, None, None, None), (None,) * 5]
    rows += [(50, "ties", "en", 1, "same")] * 3 + [(50, "ties", "en", 1, t) for t in ("A", "b", None, "")]
    rows += [(60, "", "", -1, "L" * 300_000)]
    return rows


def test_equals_brute_force_on_odd_rows(spark, odd_leaves):
    full = [("t", i, s, lang, n, t, 1, "x", {"k": 1}) for i, s, lang, n, t in odd_leaves]
    check(spark.createDataFrame(full, SCHEMA).repartition(5, F.xxhash64("text")), odd_leaves)


def test_equals_brute_force_on_the_given_table(tables):
    documents = tables["documents"]
    check(documents, [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()])


def test_equals_sql_on_odd_rows(spark, odd_leaves, tmp_path):
    columns = "doc_id bigint, source string, lang string, n_chars bigint, text string"
    documents = spark.createDataFrame(odd_leaves, columns)
    documents.write.parquet(f"{tmp_path}/documents")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    result = db.execute(ORACLE["op11_manifest"])
    assert [d[0] for d in result.description] == manifest.digest(documents).columns
    assert sorted(result.fetchall(), key=repr) == sorted(brute(odd_leaves), key=repr)


def test_a_proof_leads_to_the_root_and_a_changed_leaf_does_not(tables):
    found = manifest.proofs(tables["documents"]).withColumn("wrong", F.sha2("leaf", 256))
    leads = manifest.folded(F.col("leaf"), F.col("steps")) == F.col("root")
    wrong = manifest.folded(F.col("wrong"), F.col("steps")) == F.col("root")
    row = found.agg(F.min(leads).alias("all"), F.max(wrong).alias("any")).first()
    assert row["all"] and not row["any"]


def test_a_block_is_bounded(spark):
    nodes = spark.range(3000).selectExpr("'' AS tree", "id AS rank", "3000L AS size", "'h' AS hash", "id AS payload")
    blocks = manifest.rolled(nodes)
    leaves = F.aggregate("kids", F.lit(0), lambda n, kid: n + F.size(kid["kids"]))
    assert [r[0] for r in blocks.orderBy("block").select(leaves).collect()] == [256] * 11 + [184]


def test_no_rows(no_documents):
    assert manifest.digest(no_documents).collect() == []
