"""Packing of token sequences by best-fit decreasing.

Documents are tokenised and end with an end id. A document longer than a window is first cut into full
windows; the rests go, longest first, into the open window that they fill tightest, which a segment tree
indexed by remaining capacity finds. Rests are packed in groups of a partition's documents, so a sequence
never crosses partitions and a lost task is simply run again; nothing is shuffled.

Null and empty texts are the end id alone. Repeated rows are packed like others, extra columns are
ignored, ties go to the earlier document, and the order within a partition is that of the input.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tarmac.llm.buffers import SMALL_BYTES, Block, blocks, group_starts, ranges, stretch_hashes
from tarmac.llm.memory import returning

WINDOW = 2048
END = 1

#: Rests that are packed together; a partition's buffer holds their ids.
GROUP = 8192

#: A task remembers the ids of pieces in a table of so many slots, and at most so many ids.
SLOTS_LOG2 = 20
REMEMBERED = 8_000_000

#: Texts with a longer piece go to the tokenizer whole.
LONGEST = 64

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_END_MARK = np.zeros(256, bool)
_END_MARK[list(b".,")] = True
_SPACE, _NEWLINE = 0x20, 0x0A
# White space other than space and newline, as bytes; and NUL, which is treated alike.
_ODD = np.zeros(256, bool)
_ODD[[0x00, 0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


class TextIds:
    """Ids of the texts of a block, equal to the tokenizer's own.

    Byte-level tokenizers of this kind never join what a single space or newline between visible
    characters parts, nor a letter and a full stop or comma at the end of a piece. So the texts are cut
    there, all at once, and the ids of the pieces, which often recur, are remembered by their hashes,
    lengths and first bytes. Texts with other white space, very long pieces or the string of a special
    token go to the tokenizer whole. Words of letters only, most of the pieces, get their ids from the
    same vocabulary's ranks, which merge such a word alike at a fraction of the time.
    """

    def __init__(self, definition: str, ranks: dict[bytes, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(definition)
        self.words = tiktoken.Encoding(
            "words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        slots = 1 << SLOTS_LOG2
        self.key, self.lead = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self.length, self.at, self.count = (np.zeros(slots, np.int64) for _ in range(3))
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
        """Ids of pieces by the tokenizer, or by the ranks where that is the same."""
        # one text of all pieces, with a NUL, which no piece holds, behind each
        lengths = ends - starts + 1
        joined = np.append(data, np.uint8(0))[ranges(starts, lengths)]
        joined[np.cumsum(lengths) - 1] = 0
        pieces = joined.tobytes().decode().split("\0")[:-1]
        merge = self.words.encode_ordinary
        plain = [piece.isalpha() or (piece[:1] == " " and piece[1:].isalpha()) for piece in pieces]
        others = iter(self._whole([piece for piece, p in zip(pieces, plain, strict=True) if not p]))
        return [merge(piece) if p else next(others) for piece, p in zip(pieces, plain, strict=True)]

    def _odd_texts(self, block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts go to the tokenizer whole."""
        data = block.data
        gap = (data == _SPACE) | (data == _NEWLINE)
        odd = _ODD[data]
        odd[1:] |= gap[1:] & gap[:-1]  # two in a row
        filled = np.flatnonzero(block.lengths)
        first, last = block.starts[filled], block.ends[filled] - 1
        odd[first[gap[first]]] = True
        odd[last[gap[last]]] = True
        odd[starts[ends - starts > LONGEST]] = True
        places = np.flatnonzero(odd)
        rare = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
        if len(rare):
            padded = np.concatenate([data, np.zeros(2, np.uint8)])
            three = padded[rare].astype(np.int64) << 16 | padded[rare + 1].astype(np.int64) << 8 | padded[rare + 2]
            wide = [int.from_bytes(w, "big") for w in _WIDE if len(w) == 3]
            narrow = [int.from_bytes(w, "big") for w in _WIDE if len(w) == 2]
            places = np.append(places, rare[np.isin(three, wide) | np.isin(three >> 8, narrow)])
        found = np.zeros(len(block), bool)
        found[np.searchsorted(block.bounds, places, side="right") - 1] = True
        plain = data.tobytes()
        for token in self.special:
            at = plain.find(token)
            while at >= 0:
                found[np.searchsorted(block.bounds, at, side="right") - 1] = True
                at = plain.find(token, at + 1)
        return found

    @staticmethod
    def _cut(block: Block) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces: before a space, around a newline, before a mark that ends a piece."""
        data, n = block.data, len(block.data)
        cut = np.zeros(n + 1, bool)
        cut[block.bounds] = True
        cut[:n] |= data == _SPACE
        lines = np.flatnonzero(data == _NEWLINE)
        cut[lines] = cut[lines + 1] = True
        marks = np.flatnonzero(_END_MARK[data])
        marks = marks[marks > 0]
        marks = marks[cut[marks + 1] & ~cut[marks] & _LETTER[data[marks - 1]]]
        cut[marks] = True
        starts = np.flatnonzero(cut[:n])
        return starts, np.append(starts[1:], n)

    def _store(self, found: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Append ids; where each piece's begin, and how many there are."""
        counts = np.fromiter(map(len, found), np.int64, len(found))
        total = int(counts.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(self.used + total, np.uint32)])
        self.ids[self.used : self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
        at = self.used + np.cumsum(counts) - counts
        self.used += total
        return at, counts

    def __call__(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one text after another, and the bounds of each text's."""
        if self.used > REMEMBERED:
            self.used = 0
            self.count[:] = 0  # no entry counts any more
        data = block.data
        starts, ends = self._cut(block)
        whole = self._odd_texts(block, starts, ends)
        text = np.searchsorted(block.bounds, starts, side="right") - 1
        kept = ~whole[text]
        starts, ends, text = starts[kept], ends[kept], text[kept]
        (key,) = stretch_hashes(data, starts, ends)
        length = ends - starts
        eight = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]).tobytes(), strides=(1,))
        lead = eight[starts] & _MASKS[np.minimum(length, 8)]
        slot = (key >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
        at, count = self.at[slot], self.count[slot]
        known = (self.key[slot] == key) & (self.lead[slot] == lead) & (self.length[slot] == length) & (count > 0)
        new = np.flatnonzero(~known)
        if len(new):
            order = new[np.lexsort((length[new], lead[new], key[new]))]
            heads = group_starts(key[order], lead[order], length[order])
            one = order[heads]
            new_at, new_count = self._store(self._pieces(data, starts[one], ends[one]))
            sizes = np.diff(np.append(heads, len(order)))
            at[order], count[order] = np.repeat(new_at, sizes), np.repeat(new_count, sizes)
            for table, values in ((self.key, key), (self.lead, lead), (self.length, length), (self.at, at), (self.count, count)):
                table[slot[one]] = values[one]
        per_text = np.bincount(text, weights=count, minlength=len(block)).astype(np.int64)
        ids = self.ids[ranges(at, count)]
        if whole.any():
            rows = np.flatnonzero(whole)
            found = self._whole([block.text(i).decode("utf-8", "replace") for i in rows.tolist()])
            parts = np.split(ids, np.cumsum(per_text)[:-1])
            for row, own in zip(rows.tolist(), found, strict=True):
                parts[row], per_text[row] = np.array(own, np.uint32), len(own)
            ids = np.concatenate(parts)
        return ids, np.concatenate([[0], np.cumsum(per_text)])


class OpenWindows:
    """Open windows by remaining capacity; each tree node holds how many windows lie below it."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.stacks[capacity].append(sequence)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """The open window with the least capacity of at least ``size``, and that capacity."""
        count, node = self.count, self.leaves + size
        while not count[node]:
            while node & 1:  # right children have nothing further right below their parent
                node >>= 1
                if node <= 1:
                    return None
            node += 1
        while node < self.leaves:
            node *= 2
            node += not count[node]
        capacity = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return self.stacks[capacity].pop(), capacity


def best_fit_decreasing(sizes: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """Sequence and offset of each size; sequences are numbered from 0."""
    tree, places, used = OpenWindows(window), [(0, 0)] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found, used = (used, window), used + 1
        sequence, capacity = found
        places[i] = (sequence, window - capacity)
        if capacity > sizes[i]:
            tree.add(capacity - sizes[i], sequence)
    return places


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def pack(
    documents: DataFrame, tokenizer: str | None = None, ranks: str | None = None, window: int = WINDOW
) -> DataFrame:
    """Pieces of all documents with their ids (little-endian 32-bit) and their place in a sequence.

    ``tokenizer`` and ``ranks`` are paths of one vocabulary in two formats. The files are read by the driver
    and travel with the tasks (a few MB for any vocabulary).
    """
    with open(tokenizer or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    end = np.array([END], "<u4")

    @returning
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_ids = TextIds(definition, merges)
        base = TaskContext.get().partitionId() << 32
        used, rests = 0, []

        def rows(pieces: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*pieces, strict=True), _TYPES, strict=True)], names=_NAMES
            )

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal used, rests
            if not rests:
                return
            places = best_fit_decreasing([rest[2] for rest in rests], window)
            for at in range(0, len(rests), 1024):
                part = zip(rests[at : at + 1024], places[at : at + 1024], strict=True)
                yield rows([(*rest, base + used + sequence, offset) for rest, (sequence, offset) in part])
            used += max(sequence for sequence, _ in places) + 1
            rests = []

        for batch in batches:
            for block in blocks(batch["text"]):
                full = []
                for part in block.parts(SMALL_BYTES):
                    keys = batch["doc_id"].slice(part.first, len(part)).to_pylist()
                    ids, bounds = text_ids(part)
                    for key, a, b in zip(keys, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                        own = np.append(ids[a:b], end)
                        tokens = len(own)
                        whole = tokens // window
                        for k in range(whole):
                            piece = own[k * window : (k + 1) * window].tobytes()
                            full.append((key, k * window, window, piece, tokens, base + used, 0))
                            used += 1
                        if tokens % window:
                            start = whole * window
                            rests.append((key, start, tokens - start, own[start:].tobytes(), tokens))
                if full:
                    yield rows(full)
                if len(rests) >= GROUP:
                    yield from close()
        yield from close()

    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(packed, SCHEMA)


_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]


def digest(documents: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack(documents).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
