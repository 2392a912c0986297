"""URL filter, packing, fingerprints and the pipeline."""

import base64
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tarmac.checks.compare import connect
from tarmac.llm import decontaminate, fingerprint, line_dedup, ngram_join, packing, quality, url_filter
from tarmac.llm.buffers import blocks
from tarmac.llm.oracle import ORACLE
from tarmac.llm.queries import QUERIES


def link(kind, url):
    if kind == "canonical":
        return f"<html><head><LINK href='{url}' rel=canonical></head></html>"
    return f'<meta content="0; url={url}" http-equiv="refresh">'


PAGES = [
    (1, "http://a.net/x", None),
    (2, "HTTP://Sub.Example.NET/en/x?q=1#f", ""),
    (3, "https://free.org/a", link("canonical", "https://spam.net/b")),
    (4, "https://free.org/b", link("refresh", "/a")),
    (5, "https://free.org/fr/c", link("refresh", "https://free.org/a")),
    (6, "https://clean.org/d", link("canonical", "https://clean.org/d#top")),
    (7, "https://clean.org/e", link("refresh", "//clean.org/d")),
    (8, None, link("canonical", "https://spam.net/b")),
    (9, "no scheme", "<p>canonical</p>"),
    (10, "http://net?x=/", None),
    (11, "http://example.com/de/", "refresh"),
    (12, "ftp://x.example.com/de/y://z/#://", None),
    (13, "http://notnet/", None),
    (14, "https://clean.org/deep/f", link("refresh", "g?h=1")),
    (15, "https://clean.org/deep/g?h=1", link("refresh", "http://example.com/de/k")),
    (1, "http://a.net/x", None),
]


def test_urls(spark):
    pages = spark.createDataFrame(
        [(*p, "x", "y") for p in PAGES], "page_id bigint, url string, html string, host string, rule string"
    )
    rows = {r.page_id: r for r in url_filter.judge(pages).collect()}
    verdicts = {k: (r.host, r.path, r.rule, r.verdict) for k, r in rows.items()}
    assert verdicts == {
        1: ("a.net", "/x", "net/", "block"),
        2: ("sub.example.net", "/en/x", "example.net/en/", "allow"),
        3: ("free.org", "/a", None, "block"),
        4: ("free.org", "/b", None, "block"),
        5: ("free.org", "/fr/c", "org/fr/", "allow"),
        6: ("clean.org", "/d", None, "allow"),
        7: ("clean.org", "/e", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("net", "", None, "allow"),
        11: ("example.com", "/de/", "example.com/de/", "block"),
        12: ("x.example.com", "/de/y://z/", "example.com/de/", "block"),
        13: ("notnet", "/", None, "allow"),
        14: ("clean.org", "/deep/f", None, "block"),
        15: ("clean.org", "/deep/g", None, "block"),
    }
    assert rows[4].n_aliases == 3 and rows[7].n_aliases == 1 and rows[1].n_aliases == 0
    assert url_filter.judge(pages).count() == len(PAGES)
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_urls_run_without_python(tables, plan):
    decided = url_filter.judge(tables["pages"])
    assert not any(word in plan(decided) for word in ("Python", "Arrow", "Pandas"))


def test_urls_agree_with_sql(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    import duckdb

    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    expected = db.execute(ORACLE["op6_url_filter"])
    columns = [d[0] for d in expected.description]
    found = url_filter.judge(pages).select(*columns)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected.fetchall()))


@pytest.mark.parametrize("name", ORACLE)
def test_queries_agree_with_sql(spark, sf, name):
    expected = connect(sf).execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    df = QUERIES[name](spark, sf)
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(map(repr, expected.fetchall()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_best_fit_decreasing(sizes):
    places = packing.best_fit_decreasing(sizes, 64)
    bins = []  # the rule, by trying every open window
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        open_ = [b for b in bins if b + sizes[i] <= 64]
        if open_:
            bins[bins.index(max(open_))] += sizes[i]
        else:
            bins.append(sizes[i])
    filled = defaultdict(int)
    for (sequence, offset), size in sorted(zip(places, sizes, strict=True)):
        assert offset == filled[sequence]
        filled[sequence] += size
    assert sorted(filled.values()) == sorted(bins)


def test_ids_equal_the_tokenizers():
    """Random texts of many kinds, in small blocks, with a table that is soon full and forgotten."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    text_ids, rnd = packing.TextIds(definition, ranks), random.Random(4)
    marks = [*"abcXYZ .,.,  \n\n'\"-!?()1234é ßñ日本ا\t\0", " the", "don't", "’", "\u00a0", "\u2009", "\u3000", "\x85", "\r\n",
             "<|endoftext|>", "🙂", "x" * 70, ". ", ",\n", "\u0301"]
    plain = [*"abc de.,fX1é\n'", " the", "ing", ". ", ", "]
    for _ in range(6):
        kinds = [marks if rnd.random() < 0.3 else plain for _ in range(1500)]
        texts = ["".join(rnd.choice(kind) for _ in range(rnd.randrange(40))) for kind in kinds]
        expected = [e.ids for e in text_ids.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        for block in blocks(pa.array(texts), 5000):
            ids, bounds = text_ids(block)
            for i in range(len(block)):
                assert ids[bounds[i] : bounds[i + 1]].tolist() == expected[block.first + i], texts[block.first + i]
        text_ids.used = packing.REMEMBERED + 1


def check_packing(rows, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {k for k, _ in documents}
    for key, text in documents:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        own = sorted(pieces[key], key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == list(np.cumsum([0, *[r.length for r in own]])[:-1])
        assert sum(r.length for r in own) <= packing.WINDOW
    return sum(r.length for r in rows) / (len(sequences) * packing.WINDOW)


def test_packing_of_the_table(tables):
    documents = [(r.doc_id, r.text) for r in tables["documents"].collect()]
    assert check_packing(packing.digest(tables["documents"]).collect(), documents) > 0.97


def test_packing_of_odd_texts(make, odd_rows):
    texts = ["<|endoftext|> a", "a  b", " lead", "trail ", "tab\tx", "z\0y", "it's 'll we'd. x.,y", "ªº ²x x² a\u0301b", "\u00a0n",
             "a\n\nb \n c", "x\u2028y", "日本 語。", "a.b, c.", "\x1c q"]
    unique = {k: t for k, t in odd_rows if k is not None} | {100 + i: t for i, t in enumerate(texts)}
    check_packing(packing.digest(make(list(unique.items()))).collect(), list(unique.items()))


def test_packing_keeps_repeated_rows(odd, odd_rows, no_documents):
    rows = packing.digest(odd).where("start = 0").collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(k) for k, _ in odd_rows)
    assert packing.digest(no_documents).count() == 0


def entropy_level(window):
    counts = np.bincount(np.frombuffer(window, np.uint8))
    share = counts[counts > 0] / len(window)
    return -(share * np.log2(share)).sum() / 6 * 1000


def test_entropy_levels():
    rng = np.random.default_rng(2)
    for letters in (1, 3, 30, 250):
        data = rng.integers(0, letters, 900).astype(np.uint8)
        levels = fingerprint.levels(data)
        exact = [entropy_level(data[i : i + 64].tobytes()) for i in range(len(data) - 63)]
        assert np.abs(levels - exact).max() <= 1.01


def check_fingerprints(rows, documents):
    documents = sorted(documents)
    found = {r.doc_id: r for r in rows}
    assert len(rows) == len(documents)
    seen = {}
    for i, (key, text) in enumerate(documents):
        after = documents[(i + 1) % len(documents)][1]
        tail = len(text) // 4
        edited = text[: len(text) - tail] + after[:tail]
        r = found[key]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert seen.setdefault(text, r.fingerprint) == r.fingerprint
        assert seen.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        other = found[documents[(i + 1) % len(documents)][0]]
        like = fingerprint.likeness(fingerprint.from_text(r.fingerprint), fingerprint.from_text(other.fingerprint))
        assert r.near_next == pytest.approx(like)
        if text == edited:
            assert r.near_edited == 1


def test_fingerprints_of_the_table(tables):
    rows = fingerprint.digest(tables["documents"]).collect()
    check_fingerprints(rows, [(r.doc_id, r.text) for r in tables["documents"].collect()])
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95
    assert 0.6 < np.median([r.near_edited for r in rows]) < 0.9


def test_fingerprints_of_odd_rows(spark, make, odd, odd_rows, no_documents):
    unique = sorted({k: t or "" for k, t in odd_rows if k is not None}.items())
    check_fingerprints(fingerprint.digest(make(unique)).collect(), unique)
    check_fingerprints(fingerprint.digest(make(unique[:1])).collect(), unique[:1])
    assert sorted(str(r.doc_id) for r in fingerprint.digest(odd).collect()) == sorted(str(k) for k, _ in odd_rows)
    assert fingerprint.digest(no_documents).count() == 0


def test_pipeline(spark, sf, tables):
    """Each stage on what the one before it kept, against the operator's own decisions."""
    docs, seen = tables["documents"], []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, sf).persist()
        assert docs.columns == tables["documents"].columns, name
        seen.append((before, docs))
    (raw, good), (_, lines), (_, single), (_, clean) = seen
    labels = {r.doc_id: r.quality for r in tables["labels"].collect()}
    kept = {r.doc_id for r in good.collect()}
    assert all(k in kept for k, q in labels.items() if q == 1)
    assert sum(k in kept for k, q in labels.items() if q == 0) < 0.2 * sum(q == 0 for q in labels.values())
    assert line_dedup.repeats(lines).count() <= line_dedup.repeats(good).count()
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    groups = ngram_join.near_duplicate_groups(lines).collect()
    assert {r.doc_id for r in single.collect()} == {r.component_id for r in groups}
    leaks = {r.doc_id for r in decontaminate.decisions(single, tables["benchmark"]).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in single.collect()} - leaks
    pieces = corpus_pipeline.STAGES[-1][1](spark, clean, sf).collect()
    assert check_packing(pieces, [(r.doc_id, r.text) for r in clean.collect()]) > 0.9
    assert quality.THRESHOLD == 0.3
    assert len(corpus_pipeline.run(spark, sf).collect()) == len(pieces)


CLASHING = ("_id", "_of", "_mark", "_dropped", "_head", "_row", "n_lines", "N_Dropped", "quality_score", "N_BAD_LINES", "head",
            "row", "mark", "dropped", "key", "of", "component_id", "n", "a", "token", "sketch", "size")


def test_columns_of_any_name_and_type_pass_every_stage(spark, sf, tables):
    """Values and types of columns named as helpers are, and a map, are those of the row they came with."""
    documents = tables["documents"]
    extra = [F.concat(F.lit(f"{name} of "), F.col("doc_id")).alias(name) for name in CLASHING]
    wide = documents.select("*", *extra, F.create_map(F.lit("id"), F.col("doc_id")).alias("pairs"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = {r["doc_id"]: r for r in stage(spark, documents, sf).collect()}
        found = stage(spark, wide, sf)
        assert found.schema.simpleString() == wide.schema.simpleString(), name
        rows = found.collect()
        assert sorted(plain) == sorted(r["doc_id"] for r in rows) and rows
        for r in rows:
            assert r["text"] == plain[r["doc_id"]]["text"] and r["pairs"] == {"id": r["doc_id"]}
            assert all(r[c] == f"{c} of {r['doc_id']}" for c in CLASHING), name
    assert corpus_pipeline.STAGES[-1][1](spark, wide, sf).count() == corpus_pipeline.STAGES[-1][1](spark, documents, sf).count()
