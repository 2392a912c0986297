import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from tarmac.llm import licenses

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base(text):
    """Words, and the place and label of every phrase of the base."""
    words = WORDS.findall(lowered(text))
    found = []
    for phrase, label in licenses.BASE.items():
        parts = phrase.split(" ")
        found += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return words, found


def own_labels(words):
    """Labels of the notices that the regex library finds in the whole text, without seeds."""
    text = " ".join(words)
    for notice in licenses.NOTICES:
        head, rest = regex.escape(notice.text[: notice.exact]), regex.escape(notice.text[notice.exact :])
        if regex.search(rf"(?<![^ ]){head}(?:{rest}){{e<={notice.errors()}}}(?![^ ])", text):
            yield notice.label


def expected(text):
    words, found = base(text)
    places = [i for i, _ in found]
    labels = {label for _, label in found}
    return (
        len(words), len(found), min(places, default=None), max(places, default=None),
        ",".join(sorted(labels)), ",".join(sorted(labels | set(own_labels(words)))),
    )


COLUMNS = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")


def check(documents):
    texts = [r["text"] for r in documents.select("text").collect()]
    found = licenses.digest(documents).collect()
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in found)
    assert sorted((repr(tuple(r[c] for c in COLUMNS)) for r in found)) == sorted(repr(expected(t)) for t in texts)
    return found


def misspelt(rnd, text, edits):
    """The text with so many characters changed, dropped or put in."""
    for _ in range(edits):
        i = rnd.randrange(1, len(text) - 1)
        text = text[:i] + rnd.choice(["", "x", "é", text[i] + "q"]) + text[i + 1 :]
    return text


@pytest.fixture(scope="module")
def notices_in_texts():
    rnd = random.Random(3)
    rows = []
    for notice in licenses.NOTICES:
        for edits in range(notice.errors() + 3):
            for _ in range(4):
                rest = notice.text[notice.exact :]
                body = notice.text[: notice.exact] + (misspelt(rnd, rest, edits) if len(rest) > edits + 2 else rest)
                filler = ["ünder", "the", "été", "日本", "licens", "icense", "x" * rnd.randrange(1, 40)]
                before, after = (rnd.sample(filler, rnd.randrange(0, 5)) for _ in range(2))
                gap = rnd.choice([" ", ", ", "\n", " - "])
                rows.append(gap.join([*before, body.replace(" ", rnd.choice([" ", "  ", "-"])), *after]))
    return rows


def test_equals_brute_force_on_misspelt_notices(make, notices_in_texts):
    found = check(make(list(enumerate(notices_in_texts))))
    assert len({r["labels"] for r in found}) > 15


def test_equals_brute_force_on_odd_rows(odd):
    check(odd)


def test_equals_brute_force_on_the_given_table(tables):
    found = check(tables["documents"])
    assert any(r["labels"] for r in found)


def test_spans_are_those_of_the_text(make):
    text = "Ünder the  MIT-Licence; ähnlich GNU  General Publik Lisense, and Apache License"
    rows = {r["label"]: r for r in licenses.spans(make([(1, text)])).collect()}
    cut = {label: (text[r["start"] : r["end"]], r["edits"]) for label, r in rows.items()}
    assert cut == {"mit": ("MIT-Licence", 1), "gpl": ("GNU  General Publik Lisense", 2), "apache": ("Apache License", 0)}


def test_edits_beyond_the_bound_and_parts_of_words_do_not_count(make):
    texts = ["apaxhe lixense", "permit license", "mit licenses of", "submit licensee", "mix license", "cc bye", "cc by"]
    found = {r["doc_id"]: r["labels"] for r in licenses.digest(make(list(enumerate(texts)))).collect()}
    assert found == {0: "", 1: "", 2: "mit", 3: "", 4: "", 5: "", 6: "cc-by"}


def test_every_place_of_a_very_repetitive_text(make):
    text = "apache license " * 20_000 + "x" * 200_000 + " apache-license"
    (row,) = licenses.digest(make([(1, text)])).collect()
    assert (row["n_base"], row["first_word"], row["last_word"], row["n_matches"]) == (20_001, 0, 40_001, 20_001)


def test_nothing_is_shuffled(odd, plan):
    assert "Exchange" not in plan(licenses.digest(odd.select(F.col("doc_id"), F.col("text")))).split("InMemoryTableScan")[0]


def test_no_rows(no_documents):
    assert licenses.digest(no_documents).collect() == []
    assert licenses.spans(no_documents).collect() == []
