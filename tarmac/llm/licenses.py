"""License notices in texts, also where they are misspelt.

A text is read as its words: runs of a-z (A-Z lower-cased), digits and characters beyond ASCII. The base is
exact: places where a phrase's words stand one after another. The search for short notices is fuzzy. A notice
may differ in one character for every ten of its own; cut into one piece more than that, at least one piece
of it stands unchanged in any such text. So the pieces are searched exactly, and only around their places the
``regex`` library matches the notice with a bounded number of errors. What it finds is reported with its
place in the text and its number of edits; of matches of one notice that overlap, the one with fewer edits
(then the earlier one) is kept.

Null and empty texts have no words and no labels. Texts are searched whole and stay within a few times their
size in memory. Ties do not arise; repeated rows are scanned alike, each by itself; ids may be null or
repeated. An empty table has no rows. Extra columns, of whatever name, are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.buffers import LOWER, Block, blocks

# The phrases of the base and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: One edit is allowed for so many characters of a notice.
CHARACTERS_PER_EDIT = 10


@dataclass(frozen=True)
class Notice:
    """A notice as words with single spaces; its first ``exact`` characters must stand as they are."""

    label: str
    text: str
    exact: int = 0

    def errors(self) -> int:
        return len(self.text) // CHARACTERS_PER_EDIT

    def pieces(self) -> list[tuple[int, str]]:
        """One piece more than there may be errors, with the place of each."""
        n = self.errors() + 1
        cuts = [len(self.text) * k // n for k in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


# Names of up to four letters must be exact, or they would be found in other words.
NOTICES = (
    Notice("agpl", "gnu affero general public license"),
    Notice("all-rights-reserved", "all rights reserved"),
    Notice("apache", "apache license"),
    Notice("apache", "apache software license"),
    Notice("bsd", "bsd license", exact=4),
    Notice("bsd", "redistribution and use in source and binary forms"),
    Notice("cc-by", "cc by"),
    Notice("cc-by", "creative commons attribution"),
    Notice("cc-by-nc", "cc by nc"),
    Notice("cc-by-nc", "creative commons attribution noncommercial"),
    Notice("cc-by-nd", "cc by nd"),
    Notice("cc-by-sa", "cc by sa"),
    Notice("cc-by-sa", "creative commons attribution sharealike"),
    Notice("cc0", "cc0 1 0", exact=7),
    Notice("epl", "eclipse public license"),
    Notice("gpl", "gnu general public license"),
    Notice("isc", "isc license", exact=4),
    Notice("lgpl", "gnu lesser general public license"),
    Notice("mit", "mit license", exact=4),
    Notice("mit", "permission is hereby granted free of charge"),
    Notice("mpl", "mozilla public license"),
    Notice("public-domain", "dedicated to the public domain"),
    Notice("unlicense", "this is free and unencumbered software"),
)

_WORD = np.zeros(256, bool)
_WORD[0x80:] = _WORD[0x30:0x3A] = _WORD[0x61:0x7B] = True
_SPACE, _END = 0x20, 0x0A

#: Stretches around seeds, with what was found in them, that a task remembers.
REMEMBERED = 50_000


class Marks:
    """Counts of the marks in a long boolean array, without a number for each of its places."""

    WIDTH = 4096

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        edges = np.arange(0, len(marks), self.WIDTH)
        sums = np.add.reduceat(marks, edges, dtype=np.int64) if len(marks) else np.empty(0, np.int64)
        self.sums = np.concatenate([[0], np.cumsum(sums)])

    def before(self, i: int) -> int:
        """How many marks stand before place ``i``."""
        chunk = i // self.WIDTH
        return int(self.sums[chunk]) + int(np.count_nonzero(self.marks[chunk * self.WIDTH : i]))

    def place(self, k: int) -> int:
        """The place of mark ``k``, from 0."""
        chunk = int(np.searchsorted(self.sums, k, side="right")) - 1
        at = chunk * self.WIDTH
        return at + int(np.flatnonzero(self.marks[at : at + self.WIDTH])[k - int(self.sums[chunk])])


class Words:
    """The texts of a block as words with one space after another, each text closed by a line end."""

    def __init__(self, block: Block):
        self.block = block
        # a line end in front as well, so that every word has a neighbour on both sides
        self.padded = np.insert(LOWER[block.data], np.append(0, block.ends), _END)
        self.bounds = np.append(0, block.ends + 1 + np.arange(len(block)))  # places of the line ends put in
        word = _WORD[self.padded]
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        self.begins = Marks(begins)
        kept = word.copy()
        kept[1:] |= word[:-1]
        kept[self.bounds] = True
        self.kept = Marks(kept)
        plain = np.where(word, self.padded, np.uint8(_SPACE))
        plain[self.bounds] = _END
        self.text = plain[kept].tobytes()
        self.ends = [self.kept.before(int(b)) for b in self.bounds]  # the same line ends in ``text``

    def counts(self) -> np.ndarray:
        return np.diff([self.begins.before(int(b)) for b in self.bounds])

    def row(self, at: int) -> int:
        """The text that holds place ``at``."""
        return bisect_left(self.ends, at) - 1

    def word(self, at: int) -> int:
        """The number, within its text, of the word that begins at ``at``."""
        return self.begins.before(self.kept.place(at)) - self.begins.before(int(self.bounds[self.row(at)]))

    def character(self, at: int) -> int:
        """The character of the text as it was that stands at ``at``."""
        row = self.row(at)
        place = self.kept.place(at) - 1 - row  # without the line ends put in
        before = self.block.data[self.block.bounds[row] : place]
        return len(before) - int(np.count_nonzero((before & 0xC0) == 0x80))

    def places(self, piece: bytes) -> Iterator[int]:
        at = self.text.find(piece)
        while at >= 0:
            yield at
            at = self.text.find(piece, at + 1)


def _continues(byte: int) -> bool:
    return byte & 0xC0 == 0x80


class Search:
    """Places of notices in the words of a block."""

    def __init__(self, notices: tuple[Notice, ...] = NOTICES):
        self.notices = notices
        self.seeds: dict[bytes, list[tuple[int, int]]] = {}
        for n, notice in enumerate(notices):
            for at, piece in notice.pieces():
                self.seeds.setdefault(piece.encode(), []).append((n, len(notice.text[:at].encode())))
        self.patterns = [
            regex.compile(
                rf"(?e)(?<![^ \n]){regex.escape(n.text[: n.exact], literal_spaces=True)}"
                rf"(?:{regex.escape(n.text[n.exact :], literal_spaces=True)}){{e<={n.errors()}}}(?![^ \n])"
            )
            for n in notices
        ]
        self.matched = lru_cache(REMEMBERED)(self._matched)

    def _matched(self, n: int, around: str, opened: bool, closed: bool) -> list[tuple[int, int, int]]:
        """Byte spans and edits of a notice in a stretch, which may be cut off on either side."""
        found = []
        for match in self.patterns[n].finditer(around, pos=0 if opened else 1):
            start, end = match.span()
            if start < end and (closed or end < len(around)):
                before = len(around[:start].encode())
                found.append((before, before + len(around[start:end].encode()), sum(match.fuzzy_counts)))
        return found

    def spans(self, words: Words) -> dict[tuple[int, int], list[tuple[int, int, int]]]:
        """Spans in ``words.text`` with their edits, by row and notice."""
        found: dict[tuple[int, int], set[tuple[int, int, int]]] = {}
        text = words.text
        for piece, owners in self.seeds.items():
            for at in words.places(piece):
                row = words.row(at)
                low, high = words.ends[row], words.ends[row + 1]
                for n, offset in owners:
                    notice = self.notices[n].text
                    # an error may put in a character of four bytes, and one more shows where a word begins
                    margin = 4 * (self.notices[n].errors() + 1)
                    a = max(low, at - offset - margin)
                    b = min(high + 1, at - offset + len(notice.encode()) + margin)
                    while _continues(text[a]):
                        a += 1
                    while b <= high and _continues(text[b]):
                        b -= 1
                    around = text[a:b].decode()
                    for start, end, edits in self.matched(n, around, a == low, b > high):
                        found.setdefault((row, n), set()).add((edits, a + start, a + end))
        return {key: self._apart(spans) for key, spans in found.items()}

    @staticmethod
    def _apart(spans: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Spans that do not overlap, as ``start, end, edits``; fewer edits come first, then earlier ones."""
        kept: list[tuple[int, int, int]] = []
        for edits, start, end in sorted(spans):
            i = bisect_left(kept, (start,))
            if (i == 0 or kept[i - 1][1] <= start) and (i == len(kept) or kept[i][0] >= end):
                insort(kept, (start, end, edits))
        return kept


_BASE_TYPE = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
_MATCH_TYPE = pa.list_(
    pa.struct(
        [("label", pa.string()), ("notice", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())]
    )
)
SCHEMA = (
    "doc_id long, n_words long, base array<struct<label: string, word: long>>, "
    "matches array<struct<label: string, notice: string, start: long, end: long, edits: long>>"
)


def scan(documents: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """``doc_id, n_words, base, matches`` of every row; nothing is shuffled.

    ``base`` has the places of the base's phrases, by word; ``matches`` the notices found, with the characters
    of the text that they span and their edits.
    """

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(notices)
        for batch in batches:
            for block in blocks(batch["text"]):
                words = Words(block)
                base: list[list[dict]] = [[] for _ in range(len(block))]
                matches: list[list[dict]] = [[] for _ in range(len(block))]
                for phrase, label in BASE.items():
                    for at in words.places(phrase.encode()):
                        if words.text[at - 1] in b" \n" and words.text[at + len(phrase)] in b" \n":
                            base[words.row(at)].append({"label": label, "word": words.word(at)})
                for (row, n), spans in sorted(search.spans(words).items()):
                    notice = notices[n]
                    for start, end, edits in spans:
                        first, last = words.character(start), words.character(end - 1) + 1
                        matches[row].append(
                            {"label": notice.label, "notice": notice.text, "start": first, "end": last, "edits": edits}
                        )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(block.first, len(block)),
                        pa.array(words.counts().astype(np.int64)),
                        pa.array(base, _BASE_TYPE),
                        pa.array(matches, _MATCH_TYPE),
                    ],
                    names=["doc_id", "n_words", "base", "matches"],
                )

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(scanned, SCHEMA)


def spans(documents: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row for each notice found: ``doc_id, label, notice, start, end, edits``."""
    return scan(documents, notices).select("doc_id", F.explode("matches").alias("match")).select("doc_id", "match.*")


def digest(documents: DataFrame) -> DataFrame:
    """Counts, labels and a score: how much of the best notice stands as it should, 0 without any."""
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    likeness = F.transform("matches", lambda m: 1 - m["edits"] / F.length(m["notice"]))
    exact = F.when(F.size("base") > 0, 1.0).otherwise(0.0)
    return scan(documents).select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.word").alias("first_word"),
        F.array_max("base.word").alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat("base.label", "matches.label")).alias("labels"),
        F.greatest(exact, F.coalesce(F.array_max(likeness), F.lit(0.0))).alias("score"),
        F.size("matches").cast("long").alias("n_matches"),
    )
