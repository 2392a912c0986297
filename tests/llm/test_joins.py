"""The joins and removals against brute force: substrings, lines, shingle groups, benchmark passages."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tarmac.llm import decontaminate, line_dedup, ngram_join, substring_dedup
from tarmac.llm.buffers import Block, blocks
from tarmac.llm.components import components



def words(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n))


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    found = tokens(text)
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def substrings_expected(rows):
    first = {}
    for key, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49) if key is not None else ():
            gram = data[k : k + 50]
            first[gram] = min(first.get(gram, key), key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49) if key is not None else ():
            if first[data[k : k + 50]] < key:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def groups_expected(rows):
    rows = [(k, shingles(t)) for k, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def top(k):
        while parent[k] != k:
            k = parent[k]
        return k

    index = defaultdict(set)
    for i, (key, own) in enumerate(rows):
        for shingle in own:
            index[shingle].add(i)
    for i, (key, own) in enumerate(rows):
        common = Counter(j for s in own for j in index[s])
        for j, n in common.items():
            other, theirs = rows[j]
            if key is not None and other is not None and 100 * n >= 75 * (len(own) + len(theirs) - n):
                a, b = top(key), top(other)
                parent[max(a, b)] = min(a, b)
    return sorted(((k, len(s), None if k is None else top(k)) for k, s in rows), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_substrings_of_odd_rows(odd, odd_rows):
    assert result(substring_dedup.digest(odd)) == substrings_expected(odd_rows)


def test_substrings_of_the_table(tables):
    rows = [(r.doc_id, r.text) for r in tables["documents"].collect()]
    assert result(substring_dedup.digest(tables["documents"])) == substrings_expected(rows)


def test_substrings_of_few_letters(make):
    """Periodic texts, where anchors tie, and passages that meet at every offset."""
    rows = [(i, ("ab" * 40)[i % 3 :] + "c" * (i % 5) + ("abc" * 30)[: 20 * (i % 4)] + "a" * (70 - i)) for i in range(12)]
    assert result(substring_dedup.digest(make(rows))) == substrings_expected(rows)


def test_substrings_window_by_window(make, monkeypatch):
    """With the limits lowered, passages with many surroundings go window by window, in many slices."""
    for name, value in (("MANY", 2), ("_SLICE", 64), ("_ROWS", 8)):
        monkeypatch.setattr(substring_dedup, name, value)
    passage = "a passage that many of the documents share, with some of its surroundings " * 2
    rows = [(i, f"{i * 7919 % 101} {'q' * (i % 7)}{passage[i % 3 :]}{'z' * (i % 5)} {i * 104729 % 97} tail") for i in range(40)]
    assert result(substring_dedup.digest(make(rows))) == substrings_expected(rows)


def test_substrings_in_more_chunks_than_partitions(make, monkeypatch):
    """Chunks follow the bytes of the texts; a third of the rows has no id, another third one id with many texts."""
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", 500)
    passage = words(11, 14)
    rows = [((None, 7, k)[k % 3], f"{words(k, 4)} {passage[k % 5 :]} {words(k + 50, 3)}") for k in range(45)]
    documents = make(rows)
    n_bytes = sum(len(t.encode()) for _, t in rows)
    assert substring_dedup.chunks_of(documents) == -(-n_bytes // 500) > 8
    assert result(substring_dedup.digest(documents)) == substrings_expected(rows)


def test_groups_of_odd_rows(odd, odd_rows):
    assert result(ngram_join.near_duplicate_groups(odd)) == groups_expected(odd_rows)


def test_groups_of_the_table(tables):
    rows = [(r.doc_id, r.text) for r in tables["documents"].collect()]
    assert result(ngram_join.near_duplicate_groups(tables["documents"])) == groups_expected(rows)


def with_passages(n):
    """Texts that share long passages with many others, and a near copy of every tenth."""
    rnd = random.Random(2)
    passages = [words(100 + i, 70) for i in range(4)]
    rows = []
    for i in range(n):
        rows.append((2 * i, f"{words(1000 + i, 150)} {passages[i % 4]} {words(5000 + i, 60)}"))
        if i % 10 == 0:
            near = rows[-1][1].split(" ")
            near[rnd.randrange(len(near))] = "other"
            rows.append((2 * i + 1, " ".join(near)))
    return rows


def test_groups_beside_crowded_passages(make):
    rows = with_passages(160)
    assert result(ngram_join.near_duplicate_groups(make(rows))) == groups_expected(rows)


def test_sketches_never_understate_an_intersection():
    rnd = np.random.default_rng(3)
    sets = [rnd.integers(0, 40 + 40 * k, 3 + k * k % 997).astype(np.uint64) for k in range(120)]
    sets = [np.unique(s) for s in sets] + [np.arange(60_000, dtype=np.uint64)]
    counts = np.array([len(s) for s in sets])
    column = ngram_join.sketches(np.concatenate(sets), counts)
    assert column[-1].as_py() is None and {len(c.as_py()) for c in column[:-1]} == {16, 32, 64, 128}
    kept = ngram_join.Sketches(column.to_numpy(zero_copy_only=False))
    i, j = (a.ravel() for a in np.indices((len(sets), len(sets))))
    common = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)])
    assert kept.may_share(i, j, common).all()
    own = np.flatnonzero((i == j) & (i < 120))
    assert not kept.may_share(i[own], j[own], common[own] + 1).any()


def test_groups_need_many_rounds(make):
    """A family of texts just below the threshold to each other, so that pairs far apart in a row are looked at."""
    base = [f"w{i}" for i in range(140)]
    rows = []
    for k in range(24):
        own = list(base)
        for e in range(4 if k % 5 else 1):
            own[(11 * k + 31 * e) % 140] = f"own{k}x{e}"
        rows.append((k, " ".join(own)))
    assert result(ngram_join.near_duplicate_groups(make(rows))) == groups_expected(rows)


def test_one_document_of_each_group_stays(odd, odd_rows):
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns
    expected = {k for k, _, group in groups_expected(odd_rows) if k == group and k is not None}
    found = [r.doc_id for r in kept.collect()]
    assert sorted(k for k in found if k is not None) == sorted(expected)
    assert found.count(None) == 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("abé", max_size=12), st.text("abé", max_size=12)), max_size=8))
def test_edit_automaton(pairs):
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    assert line_dedup.edit_distances(left, right).tolist() == [min(distance(a, b), 3) for a, b in pairs]


def test_long_lines_take_bounded_memory():
    long = words(31, 5_000)
    assert len(long) > 25_000
    cut = long[:10_000] + long[10_001:]
    cases = [(long, cut, 1), (long, "x" + cut, 2), (long, "x" + cut + "y", 3), (long, long[::-1], 3), (long, "", 3)]
    cases += [("a" * 40, "a" * 39 + "b", 1)] * 2000 + [(long[:1000] + "z" + long[1001:3000], long[:3000], 1)] * 300
    cases += [("b" + long[:2000] + "q" + long[2000:3000], long[:3000], 2)] * 300
    tracemalloc.start()
    found = line_dedup.edit_distances([a for a, _, _ in cases], [b for _, b, _ in cases])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.tolist() == [d for _, _, d in cases]
    assert peak < 300 << 20


def lines_expected(rows):
    """Lines that go, for rows with different ids."""
    lines = [(k, i, line) for k, t in sorted(rows, key=lambda r: r[0]) for i, line in enumerate((t or "").split("\n"))]
    gone = set()
    for at, (key, number, line) in enumerate(lines):
        if len(line) < line_dedup.LEAST:
            continue
        for _, _, before in lines[:at]:
            near = min(len(before), len(line)) >= line_dedup.LEAST_NEAR and abs(len(before) - len(line)) <= line_dedup.EDITS
            if before == line or (near and distance(before, line) <= line_dedup.EDITS):
                gone.add((key, number))
                break
    return gone


def test_lines_of_odd_rows(make, odd_rows):
    rows = list({k: (k, (t or "")[:900]) for k, t in odd_rows if k is not None}.values())
    rows += [(60, "this line of text stands here for the first time\nshort\n"), (61, "this line of text stands hero for the first time"),
             (62, "his line of text stands here for the first tim"), (63, "this line of text stands for the first time")]
    found = {(r.doc_id, r.line) for r in line_dedup.repeats(make(rows)).collect()}
    assert found == lines_expected(rows)


def test_a_family_of_lines(make):
    """Lines in a chain of edits that share segments, more than one round reaches."""
    stem = "the quick brown fox jumps over the lazy dog number "
    rows = [(i, f"{stem}{i:03d}{'x' * (i % 4)}") for i in range(40)]
    found = {(r.doc_id, r.line) for r in line_dedup.repeats(make(rows)).collect()}
    assert found == lines_expected(rows)


def test_lines_leave_columns_and_clean_texts(odd, odd_rows):
    left = line_dedup.clean(odd)
    assert left.columns == odd.columns
    texts = {(r.doc_id, r.text) for r in left.collect()}
    assert {(1, odd_rows[0][1]), (5, None), (6, ""), (None, None), (None, odd_rows[0][1])} <= texts
    assert 3 not in {k for k, _ in texts}
    digest = {r.doc_id: r for r in line_dedup.digest(odd).where("doc_id = 18").collect()}[18]
    assert (digest.n_lines, digest.n_dropped) == (2, 2)


def contaminated_expected(rows, items):
    found = set()
    for key, text in rows:
        words = tokens(text)
        for item, passage in items:
            own = tokens(passage)
            size = min(decontaminate.STRETCH, len(own))
            for at in range(-len(own), len(words)) if own else ():
                same = [0 <= at + i < len(words) and words[at + i] == own[i] for i in range(len(own))]
                inside = [0 <= at + i < len(words) for i in range(len(own))]
                if any(100 * sum(same[i : i + size]) >= decontaminate.AGREE * size and all(inside[i : i + size])
                       for i in range(len(own) - size + 1)):
                    found.add((key, item))
    return found


def test_passages_with_replaced_words(spark, make):
    item = [f"b{i}" for i in range(40)]
    filler = " ".join(f"f{i}" for i in range(50))

    def leak(step, upto=40):
        return filler + " " + " ".join("other" if i % step == 5 % step else w for i, w in enumerate(item[:upto])) + " " + filler

    rows = [(1, leak(99)), (2, leak(9)), (3, leak(6)), (4, leak(2)), (5, filler), (6, leak(99, 12)), (7, None), (8, ""),
            (9, leak(99, 17).upper()), (10, "b0 b1 b2"), (11, "tiny item here"), (12, "a tiny item here too"), (None, leak(99))]
    items = [(1, " ".join(item)), (2, "tiny item here"), (3, None), (4, ""), (1, " ".join(item))]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    expected = contaminated_expected(rows, items)
    for per_pass in (2, 100):
        decisions = decontaminate.decisions(make(rows), benchmark, per_pass).collect()
        assert {(r.doc_id, i) for r in decisions for i in r.item_ids} == expected
        kept = decontaminate.keep_clean(make(rows), benchmark, per_pass)
        assert {r.doc_id for r in kept.collect()} == {k for k, _ in rows} - {k for k, _ in expected}
    assert {k for k, _ in expected} == {1, 2, 3, 9, 11, 12, None}


@pytest.mark.parametrize("size", range(decontaminate.LEAST, decontaminate.STRETCH + 1))
def test_seeds_cover_all_words_that_a_stretch_may_miss(size):
    masks = decontaminate.FAMILIES[max(least for least in decontaminate.FAMILIES if least <= size)]
    reads = [{i + at for i in mask} for mask in masks for at in range(size - mask[-1])]
    for missed in combinations(range(size), size - -(-decontaminate.AGREE * size // 100)):
        assert any(read.isdisjoint(missed) for read in reads), missed


def test_passages_with_words_replaced_evenly_or_at_random(spark, make):
    rnd = random.Random(4)
    passages = [[f"p{n}x{i}" for i in range(n)] for n in [*range(11, 21), 50, 200]]
    filler = " ".join(f"f{i}" for i in range(20))
    leaks = [["other" if i % step == at else w for i, w in enumerate(p)] for p in passages[-2:] for step in (4, 5) for at in range(step)]
    for passage in passages[:-2]:
        for _ in range(12):
            missed = set(rnd.sample(range(len(passage)), rnd.randint(1, 5)))
            leaks.append(["other" if i in missed else w for i, w in enumerate(passage)])
    rows = [(k, f"{filler} {' '.join(leak)} {filler}") for k, leak in enumerate(leaks)]
    items = [(len(p), " ".join(p)) for p in passages]
    found = decontaminate.decisions(make(rows), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    expected = contaminated_expected(rows, items)
    assert {(r.doc_id, i) for r in found for i in r.item_ids} == expected
    assert {k for k, _ in expected} >= set(range(18)) and len(expected) < len(rows)


def test_short_passages(spark, make):
    """Of items of 4 to 10 words three quarters suffice; items of one or two words are whole texts."""
    items = [(n, " ".join(f"p{n}x{i}" for i in range(n))) for n in range(3, 11)]
    rows = []
    for n, passage in items:
        for missed in (*combinations(range(n), 1), *combinations(range(n), 2), (0, 1, n - 1)):
            leak = ["other" if i in missed else w for i, w in enumerate(passage.split())]
            rows.append((100 * n + len(rows), f"some filler {' '.join(leak)} more"))
    expected = contaminated_expected(rows, items)
    whole = [(1, "Paris"), (2, "new york")]
    rows += [(1, "He went to paris in May"), (2, "paris "), (3, "in new york"), (4, " New  York"), (5, "york new"), (6, "paris paris")]
    benchmark = spark.createDataFrame(items + whole, "item_id bigint, text string")
    found = decontaminate.decisions(make(rows), benchmark).collect()
    assert {(r.doc_id, i) for r in found for i in r.item_ids} == expected | {(2, 1), (4, 2)}
    kept = decontaminate.keep_clean(make(rows), benchmark).collect()
    assert {r.doc_id for r in kept} == {k for k, _ in rows} - {k for k, _ in expected} - {2, 4}
    assert {i for _, i in expected} == set(range(4, 11))


def test_items_of_repeated_words_take_bounded_memory(monkeypatch):
    text, item = " ".join(["same"] * 4000), " ".join(["same"] * 800)
    texts = pa.array([text, "other " + words(5, 50), words(6, 30) + " " + " ".join(["same"] * 13), None])
    items = decontaminate.Items(np.array([7, 8]), pa.array([item, words(5, 40)]))
    (block,) = blocks(texts)
    whole = [c.tolist() for c in items.matches(block)]
    assert list(zip(*whole, strict=True)) == [(0, 0, 16, 0, 4000), (1, 1, 16, 1, 41), (2, 0, 13, 26, 43)]
    monkeypatch.setattr(decontaminate, "HITS", 20_000)
    monkeypatch.setattr(decontaminate, "LAID", 100_000)
    tracemalloc.start()
    assert [c.tolist() for c in items.matches(block)] == whole
    assert tracemalloc.get_traced_memory()[1] < 32 << 20
    tracemalloc.stop()


def test_passages_of_the_table(tables):
    """Every document that holds an item word for word is found."""
    items = [(r.item_id, " ".join(tokens(r.text))) for r in tables["benchmark"].collect()]
    exact = set()
    for r in tables["documents"].collect():
        text = f" {' '.join(tokens(r.text))} "
        exact |= {(r.doc_id, i) for i, passage in items if f" {passage} " in text}
    found = decontaminate.decisions(tables["documents"], tables["benchmark"]).collect()
    assert exact and exact <= {(r.doc_id, i) for r in found for i in r.item_ids}


def test_empty_tables(no_documents, tables):
    assert substring_dedup.digest(no_documents).count() == 0
    assert ngram_join.near_duplicate_groups(no_documents).count() == 0
    assert ngram_join.keep_one(no_documents).count() == 0
    assert line_dedup.digest(no_documents).count() == 0
    assert decontaminate.decisions(no_documents, tables["benchmark"]).count() == 0
    documents, benchmark = tables["documents"], tables["benchmark"].limit(0)
    assert decontaminate.decisions(documents, benchmark).count() == 0
    assert decontaminate.keep_clean(documents, benchmark).count() == documents.count()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(5, 5), (70, 69), (70, 69)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 1 for i in range(1, 40)} | {69: 69, 70: 69}
    assert found == expected
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("size", [0, 19, 49, 50, 51, 200])
def test_every_window_has_an_anchor(size):
    data = np.random.default_rng(size).integers(97, 100, 3 * size).astype(np.uint8)
    bounds = np.array([0, size, size, 3 * size])
    anchors = substring_dedup.Anchors(Block(data, bounds, 0))
    windows = [(t, w) for t, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) for w in range(a, b - 49)]
    covered = [(t, w) for t, a, b in zip(anchors.text, anchors.low, anchors.high, strict=True) for w in range(a, b + 1)]
    assert windows == covered
