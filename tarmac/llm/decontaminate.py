"""Benchmark decontamination by spaced seeds.

A seed reads words at fixed places of a span and ignores the rest, so it still matches when ignored words
were replaced. Seeds of all benchmark items are looked up in every document at every word; around each hit
the item is laid along the document without gaps, and the document is contaminated by the item if some
stretch of the item (``STRETCH`` words, or the whole item if it is shorter) agrees in enough of its words.

The seeds are chosen so that some seed lies on agreeing words only, wherever the words that a stretch may miss
stand; no stretch that the check would accept is overlooked. Items of three words must stand
in the text word for word. Items of one or two words, which clean texts hold by chance, must be the whole text.

Words are lower-cased (A-Z) runs without white space. Null and empty texts have no words: they neither contaminate nor are contaminated.
Repeated items and documents are judged alike, extra columns are kept, and texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.buffers import LOWER, Block, blocks, group_starts, lists, mix, ranges, stretch_hashes, word_spans
from tarmac.llm.memory import returning

#: A stretch of so many item words counts if at least ``AGREE`` of a hundred agree.
STRETCH = 16
AGREE = 75

#: Places that seeds read, by the least number of words of the items they are for. Each family covers every
#: choice of 4 missed words in 16, of 3 in 12, of 2 in 8 and of 1 in 4, which is what items up to the next family may miss.
FAMILIES = {
    16: (
        (0, 1, 2, 4, 5, 6),
        (0, 1, 3, 7, 9, 10),
        (0, 1, 3, 8, 11, 12),
        (0, 1, 2, 4, 7, 8),
        (0, 4, 9, 10, 11, 12),
    ),
    12: ((0, 1, 2, 4, 5), (0, 1, 3, 7, 8), (0, 1, 4, 6, 7), (0, 1, 3, 4, 5)),
    8: ((0, 1, 3, 4), (0, 1, 2, 3), (0, 1, 5, 6)),
    4: ((0, 1, 2), (0, 1, 3), (0, 2, 3)),
}
LEAST = min(FAMILIES)

#: Items of fewer words are looked for as whole texts only.
WITHIN = 3

#: Words of items that are laid along documents at a time.
LAID = 4 << 20

#: Hits that are held at a time, before those of one item on one diagonal become one.
HITS = 1 << 20

#: Benchmark items per pass, and bytes of their texts; each pass reads the documents once and carries its items to the tasks.
ITEMS_PER_PASS = 20_000
BYTES_PER_PASS = 32 << 20


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = word_spans(block)
    (hashes,) = stretch_hashes(LOWER[block.data], starts, ends)
    return hashes, first


def seeds(words: np.ndarray, first: np.ndarray, mask: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Position and hash of the seed at every word from which enough words of the same text follow."""
    span = mask[-1] + 1
    at = ranges(first[:-1], np.maximum(np.diff(first) - span + 1, 0))
    size = max(0, len(words) - span + 1)
    total = np.full(size, salt, np.uint64)
    for place in mask:
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[place : place + size]
    return at, mix(total[at])


def _slices(number: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of slices whose numbers come to ``most`` at most, or of single ones."""
    upto, at = np.cumsum(number), 0
    while at < len(number):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + most, side="right")))
        yield at, end
        at = end


def _once(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Every text, item and diagonal once."""
    text, item, diagonal = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((diagonal, item, text))
    text, item, diagonal = text[order], item[order], diagonal[order]
    at = group_starts(text, item, diagonal)
    return text[at], item[at], diagonal[at]


def _best(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Text, item, most agreeing words, first and last word, of every text and item."""
    text, item, count, word, last = (np.concatenate(c) for c in zip(*parts, strict=True))
    if not len(text):
        return text, item, count, word, last
    order = np.lexsort((item, text))
    text, item = text[order], item[order]
    at = group_starts(text, item)
    return (
        text[at],
        item[at],
        np.maximum.reduceat(count[order], at),
        np.minimum.reduceat(word[order], at),
        np.maximum.reduceat(last[order], at),
    )


class Items:
    """Seeds of some benchmark items, sorted by hash, and a bit table that most lookups end at."""

    BITS = 20

    def __init__(self, ids: np.ndarray, texts: pa.Array):
        parts = [(*_words(block), block.first) for block in blocks(texts, 1 << 62)]
        self.ids = ids
        self.words, self.first = (parts[0][0], parts[0][1]) if parts else (np.empty(0, np.uint64), np.zeros(1, int))
        counts = np.diff(self.first)
        hashes, places = [], []
        self.masks, limit = [], np.inf
        for least, family in FAMILIES.items():
            mine = (counts >= least) & (counts < limit)
            for mask in family if mine.any() else ():
                self.masks.append(mask)
                at, found = seeds(self.words, self.first, mask, len(self.masks))
                own = mine[np.searchsorted(self.first, at, side="right") - 1]
                hashes.append(found[own])
                places.append(at[own])
            limit = least
        # short items: all their words, hashed with their number
        self.short = sorted(set(counts[(counts > 0) & (counts < LEAST)].tolist()))
        for size in self.short:
            at = self.first[:-1][counts == size]
            hashes.append(self.runs(self.words, at, size))
            places.append(at)
        hash_ = np.concatenate([np.empty(0, np.uint64), *hashes])
        place = np.concatenate([np.empty(0, np.int64), *places])
        order = np.argsort(hash_, kind="stable")
        self.hashes, self.places = hash_[order], place[order]
        self.bits = np.zeros(1 << self.BITS, bool)
        self.bits[(self.hashes >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    @staticmethod
    def runs(words: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        total = np.full(len(at), 1000 + size, np.uint64)
        for place in range(size):
            total = total * np.uint64(0x9E3779B97F4A7C15) + words[at + place]
        return mix(total)

    def looked_up(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for salt, mask in enumerate(self.masks, 1):
            yield seeds(words, first, mask, salt)
        for size in self.short:
            number = np.maximum(np.diff(first) - size + 1, 0)
            at = ranges(first[:-1], number if size >= WITHIN else number == 1)
            yield at, self.runs(words, at, size)

    def hits(self, words: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Word positions in the documents and indexes into the sorted seeds with the same hash, some at a time."""
        for at, hash_ in self.looked_up(words, first):
            likely = np.flatnonzero(self.bits[(hash_ >> np.uint64(64 - self.BITS)).astype(np.int64)])
            at, hash_ = at[likely], hash_[likely]
            low = np.searchsorted(self.hashes, hash_)
            number = np.searchsorted(self.hashes, hash_, side="right") - low
            for a, b in _slices(number, HITS):
                yield np.repeat(at[a:b], number[a:b]), ranges(low[a:b], number[a:b])

    def matches(self, block: Block) -> tuple[np.ndarray, ...]:
        """Text, item, best agreeing words of a stretch, and first and last word of the overlap, per text and item."""
        words, first = _words(block)
        best = tuple(np.empty(0, np.int64) for _ in range(5))
        if not len(words) or not len(self.hashes):
            return best
        held, number = [], 0
        for place, entry in self.hits(words, first):
            text = np.searchsorted(first, place, side="right") - 1
            item = np.searchsorted(self.first, self.places[entry], side="right") - 1
            held.append((text, item, place - self.places[entry]))
            number += len(place)
            if number > HITS:
                held = [_once(held)]
                number = len(held[0][0])
                if number > HITS // 2:
                    best = _best([best, *self.judged(words, first, *held[0])])
                    held, number = [], 0
        best = _best([best, *self.judged(words, first, *_once(held))]) if number else best
        text, item, count, word, last = best
        return text, item, count, word - first[text], last - first[text]

    def judged(
        self, words: np.ndarray, first: np.ndarray, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray
    ) -> Iterator[tuple[np.ndarray, ...]]:
        """What the items come to on their diagonals, laid in slices of bounded memory."""
        for a, b in _slices(self.first[item + 1] - self.first[item], LAID):
            yield _best([self.laid(words, first, text[a:b], item[a:b], diagonal[a:b])])

    def laid(
        self, words: np.ndarray, first: np.ndarray, text: np.ndarray, item: np.ndarray, diagonal: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """Text, item, agreeing words, and first and end word of every stretch that agrees enough."""
        # the part of the item that lies within the text
        low = np.maximum(self.first[item], first[text] - diagonal)
        high = np.minimum(self.first[item + 1], first[text + 1] - diagonal)
        size = high - low
        own = ranges(low, size)
        agree = np.zeros(len(own) + 1, np.int64)
        np.cumsum(self.words[own] == words[own + np.repeat(diagonal, size)], out=agree[1:])
        begin = np.cumsum(size) - size
        stretch = np.minimum(STRETCH, self.first[item + 1] - self.first[item])
        fits = np.maximum(size - stretch + 1, 0)
        window = ranges(begin, fits)
        count = agree[window + np.repeat(stretch, fits)] - agree[window]
        enough = 100 * count >= AGREE * np.repeat(stretch, fits)
        pair = np.repeat(np.arange(len(size)), fits)[enough]
        word = (low + diagonal)[pair] + (window[enough] - begin[pair])
        return text[pair], item[pair], count[enough], word, word + stretch[pair]


def _pass(documents: DataFrame, items: Items) -> DataFrame:
    """For every document with a match: the items, the words that agree, and the word spans."""
    fields = ("item_ids", "agreeing", "first_word", "end_word")
    schema = "doc_id long, text_hash long, " + ", ".join(f"{f} array<long>" for f in fields)

    @returning
    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                text, item, count, low, high = items.matches(block)
                at = group_starts(text)
                number = np.diff(np.append(at, len(text)))
                rows = batch.slice(block.first, len(block)).take(pa.array(text[at]))
                columns = [lists(c.astype(np.int64), number) for c in (items.ids[item], count, low, high)]
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], rows["text_hash"], *columns], names=["doc_id", "text_hash", *fields]
                )

    rows = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string")
    )
    return rows.mapInArrow(matched, schema)


def benchmark_parts(benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS) -> Iterator[Items]:
    """The benchmark in parts of bounded size, so that what tasks carry has a fixed bound."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text is not null").distinct()
    number, size = rows.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(1, -(-number // per_pass), -(-(size or 0) // BYTES_PER_PASS))
    for part in range(parts):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        table = mine.orderBy("item_id", "text").toArrow()
        yield Items(table["item_id"].to_numpy(), table["text"])


def decisions(documents: DataFrame, benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """Contaminated documents only: ``doc_id, text_hash, item_ids, agreeing, first_word, end_word``.

    With a benchmark of several parts, a document has a row for each part that it meets.
    """
    found = [_pass(documents, items) for items in benchmark_parts(benchmark, per_pass)]
    every = found[0]
    for frame in found[1:]:
        every = every.unionByName(frame)
    return every


def keep_clean(documents: DataFrame, benchmark: DataFrame, per_pass: int = ITEMS_PER_PASS) -> DataFrame:
    """Documents without a match, as they are. Each pass filters on its own, so nothing is shuffled."""
    schema, names = documents.schema, documents.columns

    def cleaned(items: Items):
        @returning
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for block in blocks(batch["text"]):
                    keep[block.first + items.matches(block)[0]] = False
                yield batch.filter(pa.array(keep))

        return clean

    for items in benchmark_parts(benchmark, per_pass):
        documents = documents.mapInArrow(cleaned(items), schema)
    return documents.select(*[F.col(f"`{c}`") for c in names])
