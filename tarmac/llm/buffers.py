"""Texts of an Arrow batch as one byte array, and array kernels for words, hashes and runs.

The kernels work on all texts of a block at once, so that no Python code runs per byte or word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in blocks of about so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 2 << 20

# Kernels that hold many numbers for each byte work on less at a time.
SMALL_BYTES = 1 << 19

# Fixed values of the splitmix64 finalizer.
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# An odd base has an inverse, so a prefix sum of powers gives the hash of any stretch.
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


class Block:
    """Some texts in a row: their bytes, and where each starts and ends. ``first`` is the row of the first one."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first = data, bounds, first

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def starts(self) -> np.ndarray:
        return self.bounds[:-1]

    @property
    def ends(self) -> np.ndarray:
        return self.bounds[1:]

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.bounds)

    def parts(self, size: int) -> Iterator[Block]:
        """The texts in blocks of about ``size`` bytes."""
        at = 0
        while at < len(self):
            upto = max(at + 1, int(np.searchsorted(self.bounds, self.bounds[at] + size, side="right")) - 1)
            low, high = self.bounds[at], self.bounds[upto]
            yield Block(self.data[low:high], self.bounds[at : upto + 1] - low, self.first + at)
            at = upto

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets.astype(np.int64) - offsets[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The texts of a column in blocks of about ``size`` bytes, each of whole texts."""
    return Block(*byte_column(column), 0).parts(size)


class _Powers:
    """Powers of the base and of its inverse, grown when a longer block comes."""

    up = down = np.empty(0, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                powers = np.full(n, base, np.uint64)
                powers[:1] = 1
                setattr(cls, name, np.multiply.accumulate(powers))
        return cls.up, cls.down


class Stretches:
    """64-bit hashes of stretches of some data, whose sums are taken once; equal stretches have equal hashes."""

    def __init__(self, data: np.ndarray):
        up, self.down = _Powers.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        terms = data + np.uint64(1)
        terms *= up[: len(data)]
        np.cumsum(terms, out=self.sums[1:])

    def hashes(self, starts: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[starts]) * self.down[starts] + (end - starts).astype(np.uint64))


def stretch_hashes(data: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """64-bit hashes of ``data[starts:end]`` for each array of ends; equal stretches have equal hashes."""
    stretches = Stretches(data)
    return [stretches.hashes(starts, end) for end in ends]


def word_spans(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the block, and the index of the first word of each text (one more at the end).

    A word is a run of bytes other than space, tab, newline, vertical tab, form feed and carriage return.
    """
    n = len(block.data)
    if not n:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(block) + 1, np.int64)
    solid = ~SPACE[block.data]
    begins, stops = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    stops[:-1] &= ~solid[1:]
    inner = block.bounds[(block.bounds > 0) & (block.bounds < n)]
    begins[inner] = solid[inner]
    stops[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, block.bounds)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` word hashes, in order."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for i in range(size):
        total += words[i : i + n] * np.uint64((_BASE * (2 * i + 1) ** 3 | 1) & (1 << 64) - 1)
    return mix(total)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return shift + np.arange(total)


def group_starts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a new group of equal keys begins, in arrays sorted by these keys."""
    n = len(sorted_keys[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for key in sorted_keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column of ``values`` cut into lists of these lengths."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """All values of a list column, one after another."""
    if isinstance(column, pa.ChunkedArray):
        parts = [flat(chunk) for chunk in column.chunks]
        return np.concatenate(parts) if parts else np.empty(0, np.int64)
    return column.flatten().to_numpy(zero_copy_only=False)


def sliced(batch: pa.RecordBatch, parts: int = 16) -> Iterator[pa.RecordBatch]:
    """The rows of a batch of long lists, a few at a time, since the JVM holds a batch in one piece beside its heap."""
    rows = -(-batch.num_rows // parts)
    for at in range(0, batch.num_rows, max(1, rows)):
        yield batch.slice(at, rows)


def dealt(digit: np.ndarray, buckets: int, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows dealt out by a hash: one record for each bucket in use, with a list for each column.

    Spark then shuffles a few records for each task in place of one for each row.
    """
    if not len(digit):
        return
    bucket = (digit >> np.uint64(40)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    at = group_starts(bucket)
    counts = np.diff(np.append(at, len(bucket)))
    arrays = [pa.array(bucket[at].astype(np.int32))]
    arrays += [lists(column[order], counts) for column in columns.values()]
    yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])
