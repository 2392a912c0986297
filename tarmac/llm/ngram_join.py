"""Near-duplicate documents by a Jaccard join of word shingles, filtered under several token orders.

Two documents link if their sets of five-word shingles agree in at least three quarters of their union. If
they do, then under *any* global order of the tokens they share one among the first quarter of their own.
So under one order, documents that share such a prefix token meet. Many of them have little more than that
token in common, so every document brings a sketch, the counts of its tokens by some bits of their hashes: the
smaller counts of two add up to no less than their intersection, and where that is too little, no pair is made
(but for a row's pairs with its smallest id, which are few). Short digests of the sets, which never understate
an intersection either, spare most pairs the reading of both. The further orders are looked at
only with the whole sets at hand, just before the exact intersection: they do not lessen the pairs to look at.
Tokens that many documents have come last in every order, the others in the order of a hash.

What is wanted are the connected groups, so pairs that already are in one group are not looked at again.
The documents of a token stand in a row by size; in the first round each meets the one with the row's
smallest id, and in later ones those up to 16, 256, ... places away that are still in another group. A
large group of copies thus costs a few pairs for each member, never all pairs, and yet no link between
different groups is lost. Equal sets are one from the start. The sets of what is left to verify are read
again from the texts, so that only they are shuffled.

Words are runs without white space, A-Z lower-cased; with fewer than five, the whole sequence is the one
shingle. Documents without words (null and empty texts) have no shingles and stay alone. Rows with the
same id count as one document with the links of each. Rows with a null id stay alone, without a group.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.bits import bit_table, likely
from tarmac.llm.buffers import (
    LOWER, SMALL_BYTES, Block, blocks, flat, group_starts, lists, mix, ranges, shingle_hashes, sliced, stretch_hashes, word_spans,
)
from tarmac.llm.columns import free_names
from tarmac.llm.components import components
from tarmac.llm.memory import returning, returning_group
from tarmac.session import Scratch, fresh_folder, materialize

WORDS = 5
PERCENT = 75
ORDERS = 3

#: So many of the most frequent tokens come last in every order; they are sent to all tasks (16 bytes each).
#: The number bounds this table only: any set of late tokens gives the same links.
LATE = 100_000
_LOCALLY_FREQUENT = 3

#: Tokens at which so many documents meet are put last as well, and the prefixes are taken anew.
CROWD = 12

_U1 = np.uint64(1)


def shingle_sets(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every text, sorted within each text, and how many each has."""
    starts, ends, first = word_spans(block)
    (words,) = stretch_hashes(LOWER[block.data], starts, ends)
    counts = np.diff(first)
    runs = shingle_hashes(words, WORDS)
    many = np.maximum(counts - WORDS + 1, 0)
    few = np.flatnonzero((counts > 0) & (counts < WORDS))
    many_or_one = many.copy()
    many_or_one[few] = 1
    bounds = np.append(0, np.cumsum(many_or_one))
    tokens = np.empty(bounds[-1], np.uint64)
    tokens[ranges(bounds[:-1], many)] = runs[ranges(first[:-1], many)]
    if len(few):
        own = ranges(first[few], counts[few])
        place = ranges(np.zeros(len(few), np.int64), counts[few]).astype(np.uint64)
        whole = np.add.reduceat(mix(words[own] + place), np.cumsum(counts[few]) - counts[few])
        tokens[bounds[few]] = mix(whole + counts[few].astype(np.uint64))
    for low, high in _stretches(bounds):  # much faster than one sort by text and token
        tokens[low:high].sort()
    text = np.repeat(np.arange(len(block)), many_or_one)
    at = group_starts(text, tokens)
    return tokens[at], np.bincount(text[at], minlength=len(block))


def _stretches(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of the stretches of two or more."""
    several = np.flatnonzero(np.diff(bounds) > 1)
    return zip(bounds[several].tolist(), bounds[several + 1].tolist(), strict=True)


def set_keys(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every set; those of empty sets are zero."""
    a, b = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        at = (np.cumsum(counts) - counts)[full]
        a[full] = np.add.reduceat(mix(tokens + _U1), at)
        b[full] = np.bitwise_xor.reduceat(mix(tokens ^ np.uint64(0x5851F42D4C957F2D)), at)
    return a.view(np.int64), b.view(np.int64)


#: Counts of a sketch: as many as a set has some six tokens for, within these bounds.
NARROWEST, WIDEST = 16, 128


def sketches(tokens: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Counts of every set's tokens by the leading bits of a hash, a byte each; null if a count does not fit."""
    cell = (mix(tokens ^ np.uint64(0xA24BAED4963EE407)) >> np.uint64(64 - WIDEST.bit_length() + 1)).astype(np.int64)
    found: list[bytes | None] = []
    for at in range(0, len(counts), 4096):  # so many rows of counts at once
        own = counts[at : at + 4096]
        first = int(counts[:at].sum())
        of = np.repeat(np.arange(len(own)), own) * WIDEST + cell[first : first + int(own.sum())]
        table = np.bincount(of, minlength=len(own) * WIDEST).reshape(len(own), WIDEST)
        for row, width in zip(table, sketch_widths(own).tolist(), strict=True):
            row = row.reshape(width, -1).sum(axis=1)
            found.append(None if row.max(initial=0) > 255 else row.astype(np.uint8).tobytes())
    return pa.array(found, pa.binary())


def sketch_widths(n: np.ndarray) -> np.ndarray:
    return 1 << np.clip(np.ceil(np.log2(np.maximum(n, 1) / 6)).astype(np.int64), NARROWEST.bit_length() - 1, WIDEST.bit_length() - 1)


class Sketches:
    """The sketches of some rows, at every width that is at most their own."""

    def __init__(self, column: np.ndarray):
        self.width = np.array([0 if s is None else len(s) for s in column], np.int64)
        self.tables, width = {}, WIDEST
        rows = np.flatnonzero(self.width == width)
        table = self._of(column, rows, width)
        while True:
            place = np.zeros(len(column), np.int64)
            place[rows] = np.arange(len(rows))
            self.tables[width] = (table, place)
            if width == NARROWEST:
                break
            width //= 2
            own = np.flatnonzero(self.width == width)
            table = np.concatenate([table.reshape(len(rows), width, 2).sum(axis=2, dtype=np.uint16), self._of(column, own, width)])
            rows = np.concatenate([rows, own])

    @staticmethod
    def _of(column: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
        data = b"".join(column[i] for i in rows.tolist())
        return np.frombuffer(data, np.uint8).reshape(len(rows), width).astype(np.uint16)

    def may_share(self, i: np.ndarray, j: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Where rows ``i`` and ``j`` may have as many tokens in common as needed."""
        may = np.ones(len(i), bool)
        common = np.minimum(self.width[i], self.width[j])
        for width, (table, place) in self.tables.items():
            at = np.flatnonzero(common == width)
            for part in np.array_split(at, len(at) // 50_000 + 1):
                least = np.minimum(table[place[i[part]]], table[place[j[part]]]).sum(axis=1, dtype=np.int64)
                may[part] = least >= need[part]
        return may


def prefix_length(n: np.ndarray) -> np.ndarray:
    """How many leading tokens a set of ``n`` has to share one of with any larger or smaller partner."""
    return np.minimum(n, n - -(-PERCENT * n // 100) + 1)


def least_overlap(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The smallest intersection with which sets of these sizes link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def short_ids(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """A token's bucket and 32 further bits of its hash."""
    mixed = mix(tokens)
    return (mixed >> np.uint64(33)).astype(np.int64) % buckets, mixed.astype(np.uint32).view(np.int32)


def _id(bucket: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return bucket.astype(np.int64) << 32 | bits.view(np.uint32).astype(np.int64)


class Orders:
    """Global orders of the tokens: by a hash that differs per order, the late tokens last.

    Late tokens are known by their short ids, the rarest first; a table by some bits of them spares most searches.
    """

    BITS = 20
    LOW = np.int64((1 << BITS) - 1)

    def __init__(self, late: np.ndarray, buckets: int):
        late = late[np.sort(np.unique(late, return_index=True)[1])]
        self.rank = np.argsort(late, kind="stable").astype(np.uint64)
        self.late, self.buckets = late[self.rank.astype(np.int64)], buckets
        self.may_be_late = np.zeros(1 << self.BITS, bool)
        self.may_be_late[self.late & self.LOW] = True

    def keys(self, tokens: np.ndarray, order: int) -> np.ndarray:
        keys = mix(tokens + np.uint64(0x9E3779B97F4A7C15 * (order + 1) & (1 << 64) - 1)) >> _U1
        if len(self.late):
            ids = _id(*short_ids(tokens, self.buckets))
            some = np.flatnonzero(self.may_be_late[ids & self.LOW])
            at = np.minimum(np.searchsorted(self.late, ids[some]), len(self.late) - 1)
            is_late = self.late[at] == ids[some]
            keys[some[is_late]] = (_U1 << np.uint64(63)) | self.rank[at[is_late]]
        return keys

    def prefixes(self, tokens: np.ndarray, counts: np.ndarray, order: int) -> tuple[np.ndarray, ...]:
        """Tokens of every set's prefix, with the set's index and the token's place in the order."""
        text = np.repeat(np.arange(len(counts)), counts)
        keys, bounds = self.keys(tokens, order), np.append(0, np.cumsum(counts))
        sorted_ = np.arange(len(tokens))
        for low, high in _stretches(bounds):
            own = keys[low:high]
            by_key = own.argsort()
            own = own[by_key]
            if (own[1:] == own[:-1]).any():  # tokens of one key keep the order of their hashes, as everywhere
                by_key = keys[low:high].argsort(kind="stable")
            sorted_[low:high] = by_key + low
        tokens = tokens[sorted_]
        length = prefix_length(counts)
        at = ranges(np.cumsum(counts) - counts, length)
        return tokens[at], text[at], ranges(np.zeros(len(counts), np.int64), length)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def keys_and_frequent(documents: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The set keys of all documents as a shared table, and the late tokens, rarest first."""

    @returning
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"]):
                tokens, counts = shingle_sets(block)
                a, b = set_keys(tokens, counts)
                sketch = sketches(tokens, counts)
                once = np.zeros(len(block), bool)
                once[np.unique(a, return_index=True)[1]] = True  # copies do not make a token frequent
                found, often = np.unique(tokens[np.repeat(once, counts)], return_counts=True)
                found, often = found[often >= _LOCALLY_FREQUENT], often[often >= _LOCALLY_FREQUENT]
                n, m = len(block), len(found)
                ids = batch["doc_id"].slice(block.first, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat([False, True], [n, m])),
                        pa.concat_arrays([ids, pa.nulls(m, pa.int64())]),
                        pa.array(np.concatenate([counts, often])),
                        pa.array(np.concatenate([a, found.view(np.int64)])),
                        pa.array(np.concatenate([b, np.zeros(m, np.int64)])),
                        pa.concat_arrays([sketch, pa.nulls(m, pa.binary())]),
                    ],
                    names=["is_token", "doc_id", "n", "a", "b", "sketch"],
                )

    spark = documents.sparkSession
    schema = "is_token boolean, doc_id long, n long, a long, b long, sketch binary"
    path = fresh_folder(spark, "shingle-keys")
    _texts(documents).mapInArrow(read, schema).write.partitionBy("is_token").parquet(path)
    table = spark.read.schema("doc_id long, n long, a long, b long, sketch binary, is_token boolean").parquet(path)
    frequent = table.where("is_token").groupBy("a").agg(F.sum("n").alias("n"))
    frequent = frequent.orderBy(F.desc("n"), "a").limit(LATE).toArrow()
    late = frequent["a"].to_numpy()[::-1].copy().view(np.uint64)
    return table.where("not is_token").drop("is_token"), late


def shared_prefixes(documents: DataFrame, orders: Orders) -> DataFrame:
    """``bucket, token, doc_id, n, place, size``: prefix tokens (first order) that ``size`` rows of documents share.

    A task passes on equal sets once. A token is its bucket and 32 further bits of its hash here: different
    tokens that agree in these only bring some pairs together that verification then rejects.
    """
    buckets = orders.buckets

    @returning
    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for block in blocks(batch["text"], SMALL_BYTES):
                tokens, counts = shingle_sets(block)
                a, b = set_keys(tokens, counts)
                new = np.zeros(len(block), bool)
                for i, key in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
                    if counts[i] and key not in seen:
                        seen.add(key)
                        new[i] = True
                tokens, counts = tokens[np.repeat(new, counts)], counts[new]
                token, text, place = orders.prefixes(tokens, counts, 0)
                own = ids[block.first : block.first + len(block)][new]
                parts.append((*short_ids(token, buckets), own[text], counts[text], place))
                held += len(token)
                if held > 2_000_000:
                    yield from deal(parts)
                    parts, held = [], 0
        yield from deal(parts)

    def deal(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        bucket, bits, doc, n, place = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(bucket, kind="stable")  # in the order of the documents, which compresses well
        at = group_starts(bucket[order])
        counts = np.diff(np.append(at, len(order)))
        columns = [bits, doc.astype(np.int64), n.astype(np.int32), place.astype(np.int32)]
        arrays = [pa.array(bucket[order][at].astype(np.int32)), *[lists(c[order], counts) for c in columns]]
        yield from sliced(pa.RecordBatch.from_arrays(arrays, names=["bucket", "token", "doc_id", "n", "place"]))

    @returning_group
    def shared(table: pa.Table) -> pa.Table:
        token, doc, n, place = (flat(table[c]) for c in ("token", "doc_id", "n", "place"))
        order = np.lexsort((doc, token))
        token, doc, n, place = (c[order] for c in (token, doc, n, place))
        at = group_starts(token)
        size = np.diff(np.append(at, len(token)))
        differ = np.repeat(doc[at] != doc[at + size - 1], size)
        bucket = pa.array(np.full(int(differ.sum()), table["bucket"][0].as_py(), np.int32))
        columns = [pa.array(c[differ]) for c in (token, doc, n, place, np.repeat(size, size).astype(np.int64))]
        return pa.Table.from_arrays([bucket, *columns], names=["bucket", "token", "doc_id", "n", "place", "size"])

    lists_ = "token array<int>, doc_id array<long>, n array<int>, place array<int>"
    named = _texts(documents).where("doc_id is not null")
    met = named.mapInArrow(emitted, "bucket int, " + lists_).groupBy("bucket")
    return met.applyInArrow(shared, "bucket int, token int, doc_id long, n int, place int, size long")


def pairs_within(reach: tuple[int, int], star: bool):
    """For a bucket's rows: pairs of different groups, ``reach`` places apart, that the filters let through."""

    @returning_group
    def found(table: pa.Table) -> pa.Table:
        token, doc, n, place, group = (table[c].to_numpy() for c in ("token", "doc_id", "n", "place", "component"))
        order = np.lexsort((place, doc, n, token))
        token, doc, n, place, group = (c[order] for c in (token, doc, n, place, group))
        at = group_starts(token)
        size = np.diff(np.append(at, len(token)))
        several = np.minimum.reduceat(group, at) != np.maximum.reduceat(group, at)
        keep = np.repeat(several, size)
        token, doc, n, place, group = (c[keep].astype(np.int64) for c in (token, doc, n, place, group))
        index = np.arange(len(token))
        sketch = None if star else Sketches(table["sketch"].to_numpy()[order][keep])
        left, right = [], []

        def let_through(i: np.ndarray, j: np.ndarray) -> None:
            i, j = i[doc[i] != doc[j]], j[doc[i] != doc[j]]
            need = least_overlap(n[i], n[j])
            fits = (group[i] != group[j]) & (np.minimum(n[i] - place[i], n[j] - place[j]) >= need)
            fits &= 100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j])
            i, j, need = i[fits], j[fits], need[fits]
            fits = np.ones(len(i), bool) if star else sketch.may_share(i, j, need)
            left.append(np.minimum(doc[i], doc[j])[fits])
            right.append(np.maximum(doc[i], doc[j])[fits])

        near = index  # rows that the one so many places on may still match; sizes rise along a token's rows
        for d in range(1, min(reach[1], int(size.max(initial=0))) + 1):
            near = near[near + d < len(index)]
            near = near[(token[near] == token[near + d]) & (100 * n[near] // PERCENT >= n[near + d])]
            if not len(near):
                break
            if d <= reach[0]:
                continue
            let_through(near, near + d)
            if len(left) >= 64:  # pairs repeat over tokens
                merged = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
                left, right = [merged[0]], [merged[1]]
        if star and len(token):
            at = group_starts(token)
            by_id = np.lexsort((doc, token))
            let_through(np.repeat(by_id[at], np.diff(np.append(at, len(token)))), index)
        if not left:
            return pa.table({"x": pa.array([], pa.int64()), "y": pa.array([], pa.int64())})
        both = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
        return pa.table({"x": pa.array(both[0]), "y": pa.array(both[1])})

    return found


def possible(pairs: DataFrame, digests: DataFrame) -> DataFrame:
    """The pairs ``x, y`` whose sets, as 16-bit digests with repeats, still agree enough.

    Digests of equal tokens are equal, so they never agree in less than the sets do.
    """

    def enough(x: np.ndarray, y: np.ndarray) -> bool:
        values, counts = zip(np.unique(x, return_counts=True), np.unique(y, return_counts=True), strict=True)
        _, i, j = np.intersect1d(*values, assume_unique=True, return_indices=True)
        common = int(np.minimum(counts[0][i], counts[1][j]).sum())
        return common >= least_overlap(len(x), len(y))

    return _judged(pairs, digests, enough)


def verified(pairs: DataFrame, sets: DataFrame, orders: Orders) -> DataFrame:
    """The pairs ``x, y`` that share prefix tokens under every order and whose sets agree enough."""

    def agree(x: np.ndarray, y: np.ndarray) -> bool:
        x, y = x.view(np.uint64), y.view(np.uint64)
        for order in range(1, ORDERS):
            heads = [orders.prefixes(s, np.array([len(s)]), order)[0] for s in (x, y)]
            if not len(np.intersect1d(*heads, assume_unique=True)):
                return False
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= PERCENT * (len(x) + len(y) - common)

    return _judged(pairs, sets, agree)


def _judged(pairs: DataFrame, sets: DataFrame, agree: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The pairs whose ``tokens`` in ``sets`` agree."""

    @returning
    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("of_x", "of_y"):
                column = batch[name]
                values, counts = flat(column), column.value_lengths().to_numpy()
                sides.append(np.split(values, np.cumsum(counts)[:-1]))
            good = pa.array([agree(x, y) for x, y in zip(*sides, strict=True)], pa.bool_())
            yield batch.select(["x", "y"]).filter(good)

    of_x = sets.select(F.col("doc_id").alias("x"), F.col("tokens").alias("of_x"))
    of_y = sets.select(F.col("doc_id").alias("y"), F.col("tokens").alias("of_y"))
    joined = pairs.join(of_x, "x").join(of_y, "y").select("x", "y", "of_x", "of_y")
    return joined.mapInArrow(checked, "x long, y long")


def shingle_table(documents: DataFrame, pairs: DataFrame, whole: bool) -> DataFrame:
    """``doc_id, tokens`` of the documents in the pairs and of few others.

    The tokens are whole and sorted, or digests of 16 bits with repeats.
    """
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("doc_id")).distinct()
    table = bit_table(wanted.select(F.xxhash64("doc_id").alias("h")))

    @returning
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.take(pa.array(likely(table, batch["h"].to_numpy())))
            for block in blocks(some["text"], SMALL_BYTES):
                tokens, counts = shingle_sets(block)
                ids = some["doc_id"].slice(block.first, len(block))
                values = tokens.view(np.int64) if whole else tokens.astype(np.uint16).view(np.int16)
                yield pa.RecordBatch.from_arrays([ids, lists(values, counts)], names=["doc_id", "tokens"])

    named = _texts(documents).where("doc_id is not null").withColumn("h", F.xxhash64("doc_id"))
    kind = "long" if whole else "smallint"
    return named.mapInArrow(read, f"doc_id long, tokens array<{kind}>")


def near_duplicate_groups(documents: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of the documents."""
    keys, late = keys_and_frequent(documents)
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    orders = Orders(_id(*short_ids(late, buckets)), buckets)
    heads = keys.where("n > 0 and doc_id is not null").groupBy("a", "b", "n").agg(F.min("doc_id").alias("head"))
    copies = keys.where("n > 0").join(heads, ["a", "b", "n"]).where("doc_id <> head")
    edges = materialize(copies.select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct(), "copies")

    groups = components(edges)
    spark = documents.sparkSession
    with Scratch(spark) as scratch:
        met = scratch.table(shared_prefixes(documents, orders), "prefixes")
        crowded = _crowded(met)
        if len(crowded):  # once more, with the tokens last that so many documents met at
            orders = Orders(np.concatenate([crowded, _id(*short_ids(late, buckets))]), buckets)
            met = scratch.table(shared_prefixes(documents, orders), "prefixes")
        longest = met.agg(F.max("size")).first()[0] or 0
        sketched = _sketch_of(keys)
        reach = (0, 0)  # first the smallest id of each row only, which is all there is to do for two
        while reach[0] < longest:
            rows = met if not reach[1] else met.where(F.col("size") > max(2, reach[0])).join(sketched, "doc_id", "left")
            links = _links(documents, rows, groups, reach, orders)
            if not links.isEmpty():
                edges = edges.unionByName(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
                groups = components(edges)
            reach = (reach[1], 16 * max(reach[1], 1))
    return _result(keys, groups)


def _crowded(met: DataFrame) -> np.ndarray:
    """Short ids of the tokens that at least ``CROWD`` documents met at, at most ``LATE``, the rarest first."""
    sizes = met.groupBy("bucket", "token").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD)
    most = sizes.orderBy(F.desc("n"), "bucket", "token").limit(LATE).toArrow()
    return _id(most["bucket"].to_numpy(), most["token"].to_numpy())[::-1]


def _sketch_of(keys: DataFrame) -> DataFrame:
    """``doc_id, sketch``; an id with several sets has none, so that nothing is told of any of them."""
    alone = (F.min("a") == F.max("a")) & (F.min("b") == F.max("b"))
    return keys.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(F.when(alone, F.max("sketch")).alias("sketch"))


def _links(
    documents: DataFrame, met: DataFrame, groups: DataFrame, reach: tuple[int, int], orders: Orders
) -> DataFrame:
    """The links ``x, y`` of one round, as a shared table."""
    with Scratch(documents.sparkSession) as scratch:
        grouped = met.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        grouped = grouped.withColumn("component", F.coalesce("component", "doc_id"))
        meeting = grouped.groupBy("bucket").applyInArrow(pairs_within(reach, star=not reach[1]), "x long, y long")
        pairs = scratch.table(meeting.distinct(), "pairs")
        if not pairs.isEmpty():
            digests = scratch.table(shingle_table(documents, pairs, whole=False), "digests")
            pairs = scratch.table(possible(pairs, digests), "possible")
        if not pairs.isEmpty():
            sets = scratch.table(shingle_table(documents, pairs, whole=True), "shingles")
            pairs = verified(pairs, sets, orders)
        return materialize(pairs, "links")


def _result(keys: DataFrame, groups: DataFrame) -> DataFrame:
    found = keys.join(groups.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each group of near duplicates: that with the group's smallest id. All columns stay, of any type.

    Of repeated rows with that id, the one with the smallest text stays (then by a hash of its other columns);
    rows with a null id all stay.
    """
    head, row = free_names(documents, "head", "row")
    named = documents.where("doc_id is not null")
    heads = near_duplicate_groups(documents).where("doc_id = component_id").select(F.col("doc_id").alias(head)).distinct()
    kept = named.join(heads, F.col("doc_id") == F.col(head), "left_semi")
    everything = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    first = F.struct(F.col("text"), F.xxhash64(F.to_json(everything)))
    one = kept.groupBy("doc_id").agg(F.min_by(everything, first).alias(row))
    columns = [F.col(row).getField(c).alias(c) for c in documents.columns]
    return one.select(*columns).unionByName(documents.where("doc_id is null"))
