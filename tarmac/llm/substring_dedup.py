"""Removal of byte strings that an earlier document has, by a depth-limited radix grouping of suffixes.

A byte goes if some string of ``THRESHOLD`` bytes that covers it also starts in a document with a smaller
id. Suffixes are told apart only as deep as that, in passes from the most significant digit on, and a
suffix leaves the passes as soon as no other document shares its digits:

1. Of every window of the threshold's length, the least of its short strings (by hash) is its anchor. Equal
   windows have equal anchors, so only anchors are grouped: first by a hash of the ``GRAM`` bytes there,
   which is the first digit. Only anchors whose digit occurs in several documents go on.
2. The second digit is all bytes of an anchor's windows at once. If an earlier document has all of them, all
   of these windows are repeats. Else, where anchors of one first digit differ, the third digit tells their
   windows apart one by one.

Groups are equal 64-bit hashes of a later digit within equal hashes of the first. Every pass settles what it
can within a chunk of documents and passes on one row for each chunk and group, so that a passage of a third
of all documents does not gather in one task. Anchors of a first digit with many different surroundings in
some chunk are dealt out window by window instead. Chunks are documents by the hash of their id and text. There
are as many as shuffle partitions, or more if the texts of one, on average, would be over ``CHUNK_BYTES``. All
passes are one plan over one shuffle of the texts, and nothing is kept on the driver.

Null texts are empty and keep nothing; texts shorter than the threshold stay whole. Rows with the same id
do not affect each other, whatever their texts are; rows with a null id neither lose nor cost anything and are
not shuffled.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.buffers import BLOCK_BYTES, Block, blocks, flat, group_starts, lists, mix, ranges, stretch_hashes

THRESHOLD = 50
GRAM = 20
_RUN = THRESHOLD - GRAM + 1  # short strings of a window

#: A first digit with so many different surroundings in one chunk is dealt out window by window.
MANY = 64

#: Bytes of the texts of a chunk, on average. A task holds one chunk at a time, and some ten times its bytes in arrays.
CHUNK_BYTES = 64 << 20

SURROUNDED, WINDOW, SETTLED = range(3)  # kinds of records between the passes

_SLICE = 1 << 17  # windows that a task tells apart at a time
_ROWS = 1 << 14  # surroundings that a task hashes at a time


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the ``GRAM`` bytes from every position on."""
    n = len(data) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    data = np.ascontiguousarray(data)
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    hashes = mix(words[:n])
    for at in (8, GRAM - 8):
        hashes = mix(hashes + words[at : at + n])
    return hashes


class Anchors:
    """The anchors of the texts of a block: first digit, text, place, and the windows they stand for."""

    def __init__(self, block: Block):
        grams = _gram_hashes(block.data)
        windows = np.maximum(block.lengths - THRESHOLD + 1, 0)
        starts = ranges(block.starts, windows)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        reach = 1
        while 2 * reach <= _RUN:
            least = np.minimum(least[:-reach], least[reach:]) if len(least) > reach else least[:0]
            reach *= 2
        if _RUN > reach and len(least):
            least = np.minimum(least[: len(least) - (_RUN - reach)], least[_RUN - reach :])
        place = (least[starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        text = np.repeat(np.arange(len(block)), windows)
        at = group_starts(text, place)
        self.block = block
        self.place, self.text = place[at], text[at]
        self.low = starts[at]
        self.high = starts[np.append(at[1:], len(starts)) - 1] if len(at) else starts[at]
        self.gram = grams[self.place]

    def surroundings(self) -> np.ndarray:
        """Hashes of all bytes of each anchor's windows, and of its place among them."""
        (hashes,) = stretch_hashes(self.block.data, self.low, self.high + THRESHOLD)
        return mix(hashes + (self.place - self.low).astype(np.uint64))


def _chunk_blocks(table: pa.Table) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """Blocks of texts with the ids and marks of their documents."""
    for batch in table.combine_chunks().to_batches():
        ids, marks = batch["doc_id"].to_numpy(), batch["mark"].to_numpy()
        for block in blocks(batch["text"], BLOCK_BYTES // 2):
            rows = slice(block.first, block.first + len(block))
            yield block, ids[rows], marks[rows]


class Rows:
    """Rows of one kind between the passes: windows ``low`` to ``high`` of a document, or settled bytes."""

    FIELDS = {"doc_id": np.int64, "mark": np.int32, "low": np.int32, "high": np.int32, "a": np.int64, "b": np.int64}

    def __init__(self, doc_id: np.ndarray, mark: np.ndarray, low: np.ndarray, high: np.ndarray, a=None, b=None):
        self.doc_id, self.mark = doc_id.astype(np.int64), mark.astype(np.int32)
        self.low, self.high = low.astype(np.int32), high.astype(np.int32)
        self.a, self.b = (np.zeros(len(doc_id), np.int64) if x is None else x.view(np.int64) for x in (a, b))

    def __len__(self) -> int:
        return len(self.doc_id)

    def take(self, where: np.ndarray) -> Rows:
        return Rows(*[getattr(self, name)[where] for name in self.FIELDS])

    @classmethod
    def join(cls, parts: list[Rows]) -> Rows:
        if not parts:
            return cls(*[np.empty(0, kind) for kind in cls.FIELDS.values()])
        return cls(*[np.concatenate([getattr(p, name) for p in parts]) for name in cls.FIELDS])

    def settle(self) -> np.ndarray:
        """Which rows an earlier document has, among rows of equal ``a`` and ``b``."""
        order = np.lexsort((self.doc_id, self.b, self.a))
        doc = self.doc_id[order]
        at = group_starts(self.a[order], self.b[order])
        repeated = np.empty(len(self), bool)
        repeated[order] = doc > np.repeat(doc[at], np.diff(np.append(at, len(doc))))
        return repeated

    def spans(self) -> Rows:
        """The bytes of the windows, joined where they overlap or touch."""
        if not len(self):
            return self
        who = np.stack([self.doc_id, self.mark.astype(np.int64)], axis=1)
        names, doc = np.unique(who, axis=0, return_inverse=True)
        doc, low, high = _merged(np.ravel(doc), self.low, self.high.astype(np.int64) + THRESHOLD)
        return Rows(names[doc, 0], names[doc, 1], low, high)


RECORD = (
    "chunk int, kind tinyint, doc_id array<long>, mark array<int>, low array<int>, high array<int>, "
    "a array<long>, b array<long>, at array<tinyint>, bytes binary"
)


def _records(
    rows: Rows, to: np.ndarray, key: str, kind: int, chunk: int | None = None, block: Block | None = None,
    start: np.ndarray | None = None, at: np.ndarray | None = None,
) -> list[pa.RecordBatch]:
    """One record for each value of ``to``. Rows stay in the order of the documents, which compresses well.

    Rows of kind ``SURROUNDED`` carry the bytes of their windows and where in them the anchor is, from
    which the next task finds ``a`` and ``b`` again.
    """
    if not len(rows):
        return []
    order = np.argsort(to, kind="stable")
    to = to[order]
    first = group_starts(to)
    counts = np.diff(np.append(first, len(to)))
    rows = rows.take(order)
    plain = [lists(getattr(rows, n), counts) for n in ("doc_id", "mark", "low", "high")]
    none = np.zeros(len(counts), np.int64)
    hashes = [lists(getattr(rows, n), counts) if kind == WINDOW else lists(rows.a[:0], none) for n in ("a", "b")]
    if kind == SURROUNDED:
        size = (rows.high - rows.low).astype(np.int64) + THRESHOLD
        data = block.data[ranges(start[order], size)]
        ends = np.append(0, np.cumsum(size))[np.append(first, len(to))]
        held = [data[i:j].tobytes() for i, j in zip(ends, ends[1:], strict=False)]
        places = lists(at[order].astype(np.int8), counts)
    else:
        held, places = [None] * len(counts), lists(np.empty(0, np.int8), none)
    columns = {key: pa.array(to[first].astype(np.int32))}
    if chunk is not None:
        columns["chunk"] = pa.array(np.full(len(counts), chunk, np.int32))
    columns |= {"kind": pa.array(np.full(len(counts), kind, np.int8))}
    columns |= dict(zip(("doc_id", "mark", "low", "high"), plain, strict=True))
    columns |= {"a": hashes[0], "b": hashes[1], "at": places, "bytes": pa.array(held, pa.binary())}
    return [pa.RecordBatch.from_pydict(columns)]


def _table(batches: list[pa.RecordBatch], *keys: str) -> pa.Table:
    kinds = {"kind": pa.int8(), "mark": pa.list_(pa.int32()), "low": pa.list_(pa.int32()), "high": pa.list_(pa.int32()),
             "doc_id": pa.list_(pa.int64()), "a": pa.list_(pa.int64()), "b": pa.list_(pa.int64()),
             "at": pa.list_(pa.int8()), "bytes": pa.binary()}
    names = [*keys, "kind", "doc_id", "mark", "low", "high", "a", "b", "at", "bytes"]
    return pa.Table.from_batches(batches, pa.schema([(n, kinds.get(n, pa.int32())) for n in names]))


def _rows(table: pa.Table, kind: int) -> tuple[Rows, np.ndarray, pa.Table]:
    """The rows of a kind, the chunk of each, and their records."""
    mine = table.filter(pc.equal(table["kind"], kind))
    if not mine.num_rows:
        return Rows.join([]), np.empty(0, np.int64), mine
    counts = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in mine["doc_id"].chunks])
    chunk = np.repeat(mine["chunk"].to_numpy(), counts)
    hashes = [flat(mine[n]) if kind == WINDOW else None for n in ("a", "b")]
    return Rows(*[flat(mine[n]) for n in ("doc_id", "mark", "low", "high")], *hashes), chunk, mine


def _merged(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching spans [low, high) of the same document joined."""
    if not len(doc):
        return doc, low, high
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order].astype(np.int64), high[order].astype(np.int64)
    # the furthest end so far within a document, by a running maximum of ends lifted by document
    base = np.cumsum(np.append(0, doc[1:] != doc[:-1])) * (int(high.max()) + 1)
    furthest = np.maximum.accumulate(high + base)
    new = np.ones(len(doc), bool)
    new[1:] = low[1:] + base[1:] > furthest[:-1]
    at = np.flatnonzero(new)
    return doc[at], low[at], (furthest - base)[np.append(at[1:], len(doc)) - 1]


def _windows(rows: Rows, data: np.ndarray, start: np.ndarray) -> tuple[Rows, np.ndarray]:
    """Every window of the rows, whose first ones are at ``start`` in ``data``, and the row of each."""
    count = (rows.high - rows.low).astype(np.int64) + 1
    begin = ranges(start, count)
    (hashes,) = stretch_hashes(data, begin, begin + THRESHOLD)
    row = np.repeat(np.arange(len(rows)), count)
    low = ranges(rows.low.astype(np.int64), count)
    return Rows(rows.doc_id[row], rows.mark[row], low, low, rows.a[row], hashes), row


def _slices(starts: np.ndarray, weights: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole groups that weigh at most ``most``; a heavier group is a range of its own."""
    bounds = np.append(starts, len(weights)).astype(np.int64)
    before = np.append(0, np.cumsum(weights))[bounds]
    k = 0
    while k < len(starts):
        upto = max(k + 1, int(np.searchsorted(before, before[k] + most, side="right")) - 1)
        yield int(bounds[k]), int(bounds[upto])
        k = upto


def remove_repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every document; ``kept`` are its remaining bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long"), text.alias("text"))
    nameless = rows.where("doc_id is null").select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    return _remove_repeats(rows.where("doc_id is not null"), chunks_of(rows)).unionByName(nameless)


def chunks_of(rows: DataFrame) -> int:
    """The number of chunks for these texts."""
    n_bytes = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // CHUNK_BYTES))


def _remove_repeats(rows: DataFrame, chunks: int) -> DataFrame:
    mark = F.hash("text")
    chunk = F.pmod(F.xxhash64("doc_id", mark), F.lit(chunks)).cast("int")
    texts = rows.select(chunk.alias("chunk"), "doc_id", mark.alias("mark"), "text")

    def digit(hashes: np.ndarray) -> np.ndarray:
        return (hashes.view(np.uint64) >> np.uint64(33)).astype(np.int64) % chunks

    def short(grams: np.ndarray) -> np.ndarray:
        """A first digit as its bucket and 32 other bits."""
        return digit(grams) << 32 | (grams.view(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.int64)

    def first_digits(table: pa.Table) -> pa.Table:
        """The first digits of a chunk for each bucket, and those of them with many surroundings."""
        grams, around = [], []
        for block, _, _ in _chunk_blocks(table):
            anchors = Anchors(block)
            grams.append(anchors.gram)
            around.append(anchors.surroundings())
        if not grams:
            return pa.table({n: pa.array([], t) for n, t in _DIGITS.items()})
        grams, around = np.concatenate(grams), np.concatenate(around)
        order = np.lexsort((around, grams))
        once = order[group_starts(grams[order], around[order])]
        grams = grams[once]
        at = group_starts(grams)
        many = np.diff(np.append(at, len(grams))) >= MANY
        keys = short(grams[at])
        order = np.argsort(keys, kind="stable")
        keys, many = keys[order], many[order]
        at = group_starts(keys >> 32)
        counts = np.diff(np.append(at, len(keys)))
        bits = lists((keys & 0xFFFFFFFF).astype(np.uint32).view(np.int32), counts)
        flags = lists((keys[many] & 0xFFFFFFFF).astype(np.uint32).view(np.int32), np.add.reduceat(many, at, dtype=np.int64))
        chunk = pa.array(np.full(len(at), table["chunk"][0].as_py(), np.int32))
        return pa.table({"bucket": pa.array((keys[at] >> 32).astype(np.int32)), "chunk": chunk, "digits": bits, "many": flags})

    def shared_digits(table: pa.Table) -> pa.Table:
        """First digits that several chunks have, back to each of these chunks, and which of them are frequent."""
        digits = flat(table["digits"]).view(np.uint32).astype(np.int64) | table["bucket"][0].as_py() << 32
        many = np.unique(flat(table["many"]).view(np.uint32).astype(np.int64) | table["bucket"][0].as_py() << 32)
        counts = np.concatenate([c.value_lengths().to_numpy(zero_copy_only=False) for c in table["digits"].chunks])
        chunk = np.repeat(table["chunk"].to_numpy(), counts)
        order = np.argsort(digits, kind="stable")
        digits, chunk = digits[order], chunk[order]
        at = group_starts(digits)
        size = np.diff(np.append(at, len(digits)))
        shared = np.repeat(size > 1, size)
        digits, chunk = digits[shared], chunk[shared]
        order = np.argsort(chunk, kind="stable")
        digits, chunk = digits[order], chunk[order]
        at = group_starts(chunk)
        frequent = np.isin(digits, many)
        counts = np.diff(np.append(at, len(chunk)))
        flags = lists(digits[frequent], np.add.reduceat(frequent, at, dtype=np.int64) if len(at) else counts)
        return pa.table({"chunk": pa.array(chunk[at].astype(np.int32)), "digits": lists(digits, counts), "many": flags})

    def later_digits(table: pa.Table, replies: pa.Table) -> pa.Table:
        """Settles what repeats within the chunk; passes on surroundings, or windows of frequent first digits."""
        shared, many = (np.sort(flat(replies[c])) if replies.num_rows else np.empty(0, np.int64) for c in ("digits", "many"))
        held, parts = [], []
        for block, ids, marks in _chunk_blocks(table):
            anchors = Anchors(block)
            offset = block.starts[anchors.text]
            own = Rows(ids[anchors.text], marks[anchors.text], anchors.low - offset, anchors.high - offset,
                       anchors.gram, anchors.surroundings())
            held.append((block, anchors.low, anchors.place - anchors.low))
            parts.append(own)
        rows = Rows.join(parts)
        if not len(rows):
            return _table([], "bucket", "chunk")
        part = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        del parts
        start, at = (np.concatenate([h[k] for h in held]) for k in (1, 2))
        # shared with other chunks, or by several documents here
        order = np.lexsort((rows.doc_id, rows.a))
        first = group_starts(rows.a[order])
        size = np.diff(np.append(first, len(rows)))
        doc = rows.doc_id[order]
        several = np.empty(len(rows), bool)
        several[order] = np.repeat(doc[first] != doc[first + size - 1], size)
        keys = short(rows.a)
        live = np.flatnonzero(several | np.isin(keys, shared))
        rows, part, start, at, keys = rows.take(live), part[live], start[live], at[live], keys[live]
        repeated = rows.settle()
        spans = [rows.take(repeated).spans()]
        open_ = ~repeated
        by_window = np.isin(keys, many)
        chunk = table["chunk"][0].as_py()
        out = []
        for k, (block, _, _) in enumerate(held):
            mine = np.flatnonzero(open_ & ~by_window & (part == k))
            out += _records(rows.take(mine), digit(rows.a[mine]), "bucket", SURROUNDED, chunk, block, start[mine], at[mine])
        frequent = []
        for k, (block, _, _) in enumerate(held):
            mine = np.flatnonzero(open_ & by_window & (part == k))
            frequent.append(_windows(rows.take(mine), block.data, start[mine])[0])
        windows = Rows.join(frequent)
        repeated = windows.settle()
        spans.append(windows.take(repeated).spans())
        windows = windows.take(~repeated)
        out += _records(windows, digit(windows.b), "bucket", WINDOW, chunk)
        settled = Rows.join(spans)
        out += _records(settled, np.full(len(settled), chunk), "bucket", SETTLED, chunk)
        return _table(out, "bucket", "chunk")

    def groups(table: pa.Table) -> pa.Table:
        """Settles rows of equal digits of all chunks, and sends the spans back to the chunks."""
        spans, chunk, _ = _rows(table, SETTLED)
        found, chunks_ = [spans], [chunk]
        windows, chunk, _ = _rows(table, WINDOW)
        repeated = windows.settle()
        found.append(_bytes(windows.take(repeated)))
        chunks_.append(chunk[repeated])
        rows, chunk, records = _rows(table, SURROUNDED)
        if len(rows):
            data = np.frombuffer(b"".join(records["bytes"].to_pylist()), np.uint8)
            size = (rows.high - rows.low).astype(np.int64) + THRESHOLD
            start = np.cumsum(size) - size
            at = flat(records["at"]).astype(np.int64)
            for i in range(0, len(rows), _ROWS):  # the kernels need several times the memory of their bytes
                mine = slice(i, i + _ROWS)
                own = data[start[i] : start[mine][-1] + size[mine][-1]]
                begin = start[mine] - start[i]
                rows.a[mine] = _gram_hashes(own)[begin + at[mine]].view(np.int64)
                (around,) = stretch_hashes(own, begin, begin + size[mine])
                rows.b[mine] = mix(around + at[mine].astype(np.uint64)).view(np.int64)
            repeated = rows.settle()
            found.append(_bytes(rows.take(repeated)))
            chunks_.append(chunk[repeated])
            # where surroundings differ, window by window, in slices of whole first digits
            order = np.flatnonzero(~repeated)
            order = order[np.argsort(rows.a[order], kind="stable")]
            first = group_starts(rows.a[order])
            size = np.diff(np.append(first, len(order)))
            differ = np.minimum.reduceat(rows.b[order], first) != np.maximum.reduceat(rows.b[order], first) if len(order) else size
            order = order[np.repeat(differ.astype(bool), size)]
            first = group_starts(rows.a[order])
            for i, j in _slices(first, (rows.high - rows.low)[order].astype(np.int64) + 1, _SLICE):
                mine = order[i:j]
                length = (rows.high - rows.low)[mine].astype(np.int64) + THRESHOLD
                own = data[ranges(start[mine], length)]
                windows, row = _windows(rows.take(mine), own, np.cumsum(length) - length)
                repeated = windows.settle()
                found.append(_bytes(windows.take(repeated)))
                chunks_.append(chunk[mine][row[repeated]])
        chunk = np.concatenate(chunks_)
        every = Rows.join(found)
        parts = []
        for k in np.unique(chunk):
            mine = every.take(chunk == k)
            mine.high = mine.high - THRESHOLD
            parts.append((k, mine.spans()))
        to = np.repeat([k for k, _ in parts], [len(p) for _, p in parts])
        return _table(_records(Rows.join([p for _, p in parts]), to, "chunk", SETTLED), "chunk")

    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        rows = _rows(replies, SETTLED)[0]
        out: list[list] = [[] for _ in _NAMES]
        for batch in table.combine_chunks().to_batches():
            ids, marks = batch["doc_id"].to_numpy(), batch["mark"].to_numpy()
            for block in blocks(batch["text"]):
                part = slice(block.first, block.first + len(block))
                text, row = _matched(ids[part], marks[part], rows)
                text, low, high = _merged(text, rows.low[row], rows.high[row])
                removed = np.bincount(text, high - low, len(block)).astype(np.int64)
                spans = np.bincount(text, minlength=len(block))
                gone = np.zeros(len(block.data) + 1, np.int32)
                np.add.at(gone, block.starts[text] + low, 1)
                np.add.at(gone, block.starts[text] + high, -1)
                keep = np.cumsum(gone)[:-1] == 0
                left = block.data[keep]
                bounds = np.append(0, np.cumsum(block.lengths - removed))
                kept = [left[bounds[i] : bounds[i + 1]].tobytes() for i in range(len(block))]
                ids_ = batch["doc_id"].slice(block.first, len(block)).to_pylist()
                for column, values in zip(out, (ids_, block.lengths, removed, spans, kept), strict=True):
                    column.extend(values)
        return pa.table({n: pa.array(c, t) for n, t, c in zip(_NAMES, _TYPES, out, strict=True)})

    by_chunk = texts.groupBy("chunk")
    lists_ = "digits array<{}>, many array<{}>"
    firsts = by_chunk.applyInArrow(first_digits, "bucket int, chunk int, " + lists_.format("int", "int"))
    shared = firsts.groupBy("bucket").applyInArrow(shared_digits, "chunk int, " + lists_.format("long", "long"))
    later = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(later_digits, "bucket int, " + RECORD)
    spans = later.groupBy("bucket").applyInArrow(groups, RECORD)
    return by_chunk.cogroup(spans.groupBy("chunk")).applyInArrow(cut, SCHEMA)


def _bytes(rows: Rows) -> Rows:
    """Windows as the bytes that they cover."""
    return Rows(rows.doc_id, rows.mark, rows.low, rows.high.astype(np.int64) + THRESHOLD)


_DIGITS = {"bucket": pa.int32(), "chunk": pa.int32(), "digits": pa.list_(pa.int32()), "many": pa.list_(pa.int32())}
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def _matched(ids: np.ndarray, marks: np.ndarray, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a text of the block and a row that belongs to it."""
    order = np.lexsort((rows.mark, rows.doc_id))
    doc, mark = rows.doc_id[order], rows.mark[order]
    low = np.searchsorted(doc, ids)
    count = np.searchsorted(doc, ids, side="right") - low
    text, at = np.repeat(np.arange(len(ids)), count), ranges(low, count)
    fits = mark[at] == marks[text]
    return text[fits], order[at[fits]]


def digest(documents: DataFrame) -> DataFrame:
    kept = remove_repeats(documents)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
