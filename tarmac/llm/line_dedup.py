"""Near-duplicate lines by a segment-partition edit join.

A line goes if an equal line, or one within ``EDITS`` edits (insertions, deletions, substitutions of code
points), stands earlier: in a document with a smaller id or further up in the same one. It is judged on the
input, not on what is left. Lines shorter than ``LEAST`` code points always stay, and lines shorter than
``LEAST_NEAR`` are compared for equality only.

Two lines within ``EDITS`` edits agree in one of the ``EDITS + 1`` even segments of the shorter one. Every
line is indexed by its segments and probes, for each length up to ``EDITS`` less than its own, the
substrings that can be such a segment; lines that meet are verified by a bit-parallel edit automaton over
the band of diagonals, for all pairs of a batch at once.

Only whether some earlier line is near matters. So of the lines that share a segment each meets its
predecessor and the earliest in a first round, and in later rounds those up to 16, 256, ... places before
it, as long as it is not gone yet. Pairs whose code point counts differ by more than the edits can change
are not formed, which clears families of lines that share most of their text but are not near.

Null and empty texts have one empty line, which stays. Rows with the same id and text are judged as one;
rows with a null id keep all lines and take none away. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.bits import bit_table, likely
from tarmac.llm.buffers import SMALL_BYTES, Block, Stretches, blocks, flat, group_starts, lists, mix, sliced
from tarmac.llm.columns import free_names
from tarmac.llm.memory import returning, returning_group
from tarmac.session import Scratch, materialize

EDITS = 2
LEAST = 20
LEAST_NEAR = 32

#: Distinct lines that a task remembers so as to pass each on once. Only bounds memory: what is passed on twice is merged.
SEEN = 200_000


class Lines:
    """Lines of a block with at least ``LEAST`` code points: text, number in the text, and extent in code points."""

    def __init__(self, block: Block):
        self.points = np.frombuffer(block.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
        before = np.zeros(len(block.data) + 1, np.int64)
        np.cumsum((block.data & 0xC0) != 0x80, out=before[1:])
        bounds = before[block.bounds]
        breaks = np.flatnonzero(self.points == 10)
        inside = np.searchsorted(bounds, breaks, side="right") - 1
        begin = np.concatenate([bounds[:-1], breaks + 1])
        text = np.concatenate([np.arange(len(block)), inside])
        order = np.lexsort((begin, text))
        begin, text = begin[order], text[order]
        at = group_starts(text)
        number = np.arange(len(text)) - np.repeat(at, np.diff(np.append(at, len(text))))
        end = np.append(begin[1:], len(self.points) + 1) - 1
        end[np.append(at[1:], len(text)) - 1] = bounds[text[at] + 1]
        keep = end - begin >= LEAST
        self.text, self.number, self.begin, self.end = text[keep], number[keep], begin[keep], end[keep]

    @property
    def size(self) -> np.ndarray:
        return self.end - self.begin

    @cached_property
    def stretches(self) -> Stretches:
        return Stretches(self.points.astype(np.uint64))

    def keys(self) -> np.ndarray:
        """A hash of every line."""
        return self.stretches.hashes(self.begin, self.end).view(np.int64)

    def further_keys(self) -> np.ndarray:
        """Another hash of every line."""
        wide = self.points.astype(np.uint64)
        wide *= wide
        wide += np.uint64(11)
        return Stretches(wide).hashes(self.begin, self.end).view(np.int64)

    def meetings(self, line: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Some lines, the hashes under which they meet others, and whether they probe (or are indexed)."""
        line = line[self.size[line] >= LEAST_NEAR]
        size = self.size[line]
        parts = EDITS + 1
        for short in range(EDITS + 1):  # by how much the indexed line is shorter
            length = size - short
            for i in range(parts):
                # the last ``length % parts`` segments are one longer
                small, longer = length // parts, length % parts
                start = i * small + np.maximum(i - (parts - longer), 0)
                width = small + (i >= parts - longer)
                low = np.maximum(start - i, start + short - (EDITS - i))
                high = np.minimum(start + i, start + short + (EDITS - i))
                for offset in range(-EDITS, 2 * EDITS + 1):
                    at = start + offset
                    fits = (at >= low) & (at <= high) & (at >= 0) & (at + width <= size)
                    fits &= length >= LEAST_NEAR
                    if not fits.any():
                        continue
                    begin = self.begin[line[fits]] + at[fits]
                    hashes = self.stretches.hashes(begin, begin + width[fits])
                    hashes = mix(hashes + (length[fits] * parts + i).astype(np.uint64))
                    yield line[fits], hashes, True
                    if short == 0 and offset == 0:
                        yield line[fits], hashes, False

    def points_of(self, line: int) -> str:
        return self.points[self.begin[line] : self.end[line]].tobytes().decode("utf-32-le", "replace")


#: Cells of the padded tables that pairs are compared in at a time; a pair of longer lines is compared alone.
CELLS = 2 << 20

#: Pairs in which both lines are longer than this lose their common ends first, which changes no distance.
LONG = 1024


def _inner(left: str, right: str) -> tuple[str, str]:
    """The texts without the code points with which both begin, and those with which both end."""
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in (left, right))
    n = min(len(a), len(b))
    begin = int(np.argmin(np.append(a[:n] == b[:n], False)))
    n -= begin
    end = int(np.argmin(np.append(a[len(a) - n :][::-1] == b[len(b) - n :][::-1], False)))
    return left[begin : len(a) - end], right[begin : len(b) - end]


def edit_distances(left: list[str], right: list[str], most: int = EDITS) -> np.ndarray:
    """Edit distances of pairs, where at most ``most``; ``most + 1`` stands for more.

    Pairs are compared by length, in slices of bounded memory.
    """
    result = np.full(len(left), most + 1, np.int64)
    pairs = [_inner(a, b) if min(len(a), len(b)) > LONG else (a, b) for a, b in zip(left, right, strict=True)]
    # lengths too far apart need no table
    near = np.array([i for i, (a, b) in enumerate(pairs) if abs(len(a) - len(b)) <= most], np.int64)
    size = np.array([max(map(len, pairs[i])) + 2 * most + 2 for i in near], np.int64)
    order = np.argsort(size, kind="stable")
    near, size = near[order], size[order]
    at = 0
    while at < len(near):
        cells = np.arange(1, len(near) - at + 1) * size[at:]
        end = at + max(1, int(np.searchsorted(cells, CELLS, side="right")))
        some = near[at:end]
        result[some] = _banded([pairs[i][0] for i in some], [pairs[i][1] for i in some], most)
        at = end
    return result


def _banded(left: list[str], right: list[str], most: int) -> np.ndarray:
    """The distances of pairs of similar length.

    For each number of edits, the reachable diagonals of a pair are the bits of one number, and all pairs
    move on by one code point of the right text at a time, until none has a diagonal left.
    """
    n, band = len(left), 2 * most + 1
    sizes = [np.array([len(t) for t in side], np.int64) for side in (left, right)]
    result = np.full(n, most + 1, np.int64)
    longest = int(max(s.max() for s in sizes))
    # the band reaches beyond both ends of the left text, where nothing agrees
    a, b = np.full((n, longest + band + 1), 0xFFFFFFFF, np.uint32), np.full((n, longest + 1), 0xFFFFFFFE, np.uint32)
    for table, texts, shift in ((a, left, most), (b, right, 0)):
        for row, text in enumerate(texts):
            table[row, shift : shift + len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    goal = sizes[0] - sizes[1] + most
    inside = (goal >= 0) & (goal < band)
    mask = np.uint32((1 << band) - 1)
    one = np.uint32(1)
    # before any code point, diagonal d > 0 takes d deletions
    reach = [np.full(n, ((1 << (e + 1)) - 1) << most, np.uint32) & mask for e in range(most + 1)]

    def note(step: int) -> None:
        done = np.flatnonzero((sizes[1] == step) & inside)
        for e in range(most, -1, -1):
            hit = done[(reach[e][done] >> goal[done].astype(np.uint32)) & one == 1]
            result[hit] = e

    note(0)
    ends = set(sizes[1].tolist())
    rows = max(1, 65_536 // n)
    for step in range(longest):
        if step % rows == 0:  # what agrees on each diagonal, for some steps at once
            upto = min(step + rows, longest)
            agrees = np.zeros((upto - step, n), np.uint32)
            for d in range(band):
                agrees |= (a[step + d : upto + d] == b[step:upto]).astype(np.uint32) << np.uint32(d)
        same = agrees[step % rows]
        new: list[np.ndarray] = []
        for e in range(most + 1):
            now = reach[e] & same
            if e:
                # substitution keeps the diagonal, insertion lowers it, deletion raises that of this step
                now |= reach[e - 1] | (reach[e - 1] >> one) | (new[e - 1] << one)
            new.append(now & mask)
        reach = new
        if step + 1 in ends:
            note(step + 1)
        if step % 64 == 63 and not reach[most].any():
            break
    return result


COUNTERS = 16


def point_counts(contents: list[str]) -> np.ndarray:
    """How many code points of every line fall into each of 16 classes, modulo 16, as four bits each.

    An edit changes the counts by two in sum at most, so near lines have near counts.
    """
    size = np.array([len(c) for c in contents], np.int64)
    points = np.frombuffer("".join(contents).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    line = np.repeat(np.arange(len(size)), size)
    kind = (mix(points) & np.uint64(COUNTERS - 1)).astype(np.int64)
    counts = np.bincount(line * COUNTERS + kind, minlength=len(size) * COUNTERS).reshape(-1, COUNTERS)
    shifts = np.arange(COUNTERS, dtype=np.uint64) * np.uint64(4)
    return ((counts % 16).astype(np.uint64) << shifts).sum(axis=1, dtype=np.uint64).view(np.int64)


def _classes(counts: np.ndarray) -> np.ndarray:
    """The counts as one row of small numbers for each class."""
    return np.stack([(counts >> shift & 15).astype(np.uint8) for shift in range(0, 64, 4)])


def _apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The least by which the counts behind two sets of columns can differ, in sum over the classes."""
    total = np.zeros(np.broadcast_shapes(x[0].shape, y[0].shape), np.uint8)
    for a, b in zip(x, y, strict=True):
        d = (a - b) & 15
        total += np.minimum(d, 16 - d)
    return total


def _named(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return documents.where("doc_id is not null").select(
        F.col("doc_id").cast("long"), F.hash(text).alias("mark"), text.alias("text")
    )


def line_table(documents: DataFrame) -> DataFrame:
    """``doc_id, mark, line, a, b``: place and keys of every line that counts."""

    @returning
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"], SMALL_BYTES):
                found = Lines(block)
                row = pa.array(found.text + block.first)
                a, b = found.keys(), found.further_keys()
                columns = [batch["doc_id"].take(row), batch["mark"].take(row), pa.array(found.number.astype(np.int32))]
                names = ["doc_id", "mark", "line", "a", "b"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(a), pa.array(b)], names=names)

    return _named(documents).mapInArrow(read, "doc_id long, mark int, line int, a long, b long")


def meetings(documents: DataFrame) -> DataFrame:
    """``bucket, meets, a, probes``: lines that share a segment with another; a task passes on equal lines once."""
    buckets = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    @returning
    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # lines that are dealt already or held
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            for block in blocks(batch["text"], SMALL_BYTES):
                found = Lines(block)
                a = found.keys()
                own, at = np.unique(a, return_index=True)
                new = [key not in seen for key in own.tolist()]
                if len(seen) + len(own) > SEEN:
                    seen.clear()
                seen.update(own.tolist())
                for line, hashes, probes in found.meetings(at[new]):
                    parts.append((hashes, a[line], np.full(len(line), probes)))
                    held += len(line)
                if held > 1_500_000:
                    yield from sliced(deal(parts))
                    parts, held = [], 0
        if parts:
            yield from sliced(deal(parts))

    def deal(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        meets, a, probes = (np.concatenate(c) for c in zip(*parts, strict=True))
        bucket = ((meets >> np.uint64(33)).astype(np.int64) % buckets).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        at = group_starts(bucket[order])
        counts = np.diff(np.append(at, len(order)))
        columns = [lists(c[order], counts) for c in (meets.view(np.int64), a, probes)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[order][at]), *columns], names=["bucket", "meets", "a", "probes"])

    @returning_group
    def shared(table: pa.Table) -> pa.Table:
        meets, a, probes = (flat(table[c]) for c in ("meets", "a", "probes"))
        order = np.lexsort((probes, a, meets))
        meets, a, probes = meets[order], a[order], probes[order]
        once = group_starts(meets, a, probes)
        meets, a, probes = meets[once], a[once], probes[once]
        at = group_starts(meets)
        size = np.diff(np.append(at, len(meets)))
        both = np.logical_or.reduceat(probes, at) & ~np.logical_and.reduceat(probes, at)
        keep = np.repeat(both & (a[at] != a[at + size - 1]), size)
        bucket = pa.array(np.full(int(keep.sum()), table["bucket"][0].as_py(), np.int32))
        columns = [pa.array(c[keep]) for c in (meets, a, probes)]
        return pa.Table.from_arrays([bucket, *columns], names=["bucket", "meets", "a", "probes"])

    dealt = "bucket int, meets array<long>, a array<long>, probes array<boolean>"
    met = _named(documents).mapInArrow(emitted, dealt).groupBy("bucket")
    return met.applyInArrow(shared, "bucket int, meets long, a long, probes boolean")


def met_lines(documents: DataFrame, met: DataFrame) -> DataFrame:
    """``a, place, content, counts`` of the lines that met others: where each stands first, and what it is."""
    keys = met.select("a").distinct()
    table = bit_table(keys.withColumnRenamed("a", "h"))

    @returning
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch["text"], SMALL_BYTES):
                found = Lines(block)
                a = found.keys()
                some = likely(table, a)
                row = pa.array(found.text[some] + block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(a[some]),
                        batch["doc_id"].take(row),
                        batch["mark"].take(row),
                        pa.array(found.number[some].astype(np.int32)),
                        pa.array([found.points_of(i) for i in some], pa.string()),
                    ],
                    names=["a", "doc_id", "mark", "line", "content"],
                )

    rows = _named(documents).mapInArrow(read, "a long, doc_id long, mark int, line int, content string")
    first = rows.groupBy("a").agg(F.min(F.struct("doc_id", "mark", "line", "content")).alias("first"))
    wanted = first.join(keys, "a", "left_semi").select("a", "first.*")

    @returning
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = pa.array(point_counts(batch["content"].to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, "counts"])

    schema = "a long, doc_id long, mark int, line int, content string, counts long"
    return wanted.mapInArrow(counted, schema)


def pairs_within(reach: tuple[int, int], star: bool):
    """For a bucket's rows: pairs of a line that is not gone and an earlier one, ``reach`` places apart."""

    @returning_group
    def found(table: pa.Table) -> pa.Table:
        columns = ("meets", "a", "probes", "gone", "counts", "doc_id", "mark", "line")
        meets, a, probes, gone, counts, *place = (table[c].to_numpy() for c in columns)
        order = np.lexsort((probes, a, *reversed(place), meets))
        meets, a, probes, gone, counts = (c[order] for c in (meets, a, probes, gone, counts))
        index, classes = np.arange(len(meets)), _classes(counts)
        earlier, later = [np.empty(0, np.int64)], [np.empty(0, np.int64)]

        def add(i: np.ndarray, j: np.ndarray) -> None:
            fits = np.flatnonzero((probes[i] != probes[j]) & (a[i] != a[j]) & ~gone[j])
            fits = fits[_apart(classes[:, i[fits]], classes[:, j[fits]]) <= 2 * EDITS]
            if len(fits):
                earlier.append(a[i[fits]])
                later.append(a[j[fits]])

        at = group_starts(meets)
        size = np.diff(np.append(at, len(meets)))
        if reach[1] <= 16:
            for d in range(reach[0] + 1, min(reach[1], int(size.max())) + 1):
                i = index[: len(index) - d]
                i = i[meets[i] == meets[i + d]]
                add(i, i + d)
        else:  # few groups are as large as that: in each, tiles of rows against rows
            for first, n in zip(at[size > reach[0]], size[size > reach[0]], strict=True):
                left = first + np.flatnonzero(~gone[first : first + n])
                left = left[left > first + reach[0]]
                for j in np.array_split(left, -(-len(left) // 128)) if len(left) else ():
                    low, high = max(first, j[0] - reach[1]), j[-1] - reach[0]
                    for k in range(low, high, 4096):
                        i = np.arange(k, min(k + 4096, high))
                        near = _apart(classes[:, i][:, None], classes[:, j][:, :, None]) <= 2 * EDITS
                        near &= (j[:, None] - i > reach[0]) & (j[:, None] - i <= reach[1])
                        tile = np.nonzero(near)
                        add(i[tile[1]], j[tile[0]])
        if star:
            for k in (0, 1):  # the earliest line may stand here as indexed, as probing, or as both
                head = np.repeat(np.minimum(at + k, at + size - 1), size)
                add(head[head < index], index[head < index])
        both = np.unique(np.stack([np.concatenate(earlier), np.concatenate(later)]), axis=1)
        return pa.table({"x": pa.array(both[0]), "y": pa.array(both[1])})

    return found


def near_repeats(documents: DataFrame) -> DataFrame:
    """``a``: keys of lines that have an earlier line within the edits, other than themselves."""
    spark = documents.sparkSession
    with Scratch(spark) as scratch:
        met = scratch.table(meetings(documents), "line-meetings")
        return _near_repeats(documents, met, scratch)


def _near_repeats(documents: DataFrame, met: DataFrame, scratch: Scratch) -> DataFrame:
    spark = documents.sparkSession
    longest = met.groupBy("meets").count().agg(F.max("count")).first()[0] or 0
    gone = spark.createDataFrame([], "a long")
    if not longest:
        return gone
    lines = scratch.table(met_lines(documents, met), "met-lines")

    @returning
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                distance = edit_distances(part["of_x"].to_pylist(), part["of_y"].to_pylist())
                yield part.select(["y"]).filter(pa.array(distance <= EDITS)).rename_columns(["a"])

    of_x = lines.select(F.col("a").alias("x"), F.col("content").alias("of_x"))
    of_y = lines.select(F.col("a").alias("y"), F.col("content").alias("of_y"))
    reach = (0, 1)
    while reach[0] < longest:
        state = lines.join(gone.distinct().withColumn("gone", F.lit(True)), "a", "left")
        state = state.select("a", "doc_id", "mark", "line", "counts", F.coalesce("gone", F.lit(False)).alias("gone"))
        buckets = met.join(state, "a").groupBy("bucket")
        pairs = buckets.applyInArrow(pairs_within(reach, star=reach[0] == 0), "x long, y long").distinct()
        joined = pairs.join(of_x, "x").join(of_y, "y").select("y", "of_x", "of_y")
        gone = gone.unionByName(materialize(joined.mapInArrow(near, "a long").distinct(), "near-lines"))
        reach = (reach[1], 16 * reach[1])
    return gone.distinct()


def repeats(documents: DataFrame) -> DataFrame:
    """``doc_id, mark, line`` of every line that goes, as a shared table."""
    near = near_repeats(documents).withColumn("near", F.lit(True))
    place = F.struct("doc_id", "mark", "line")
    with Scratch(documents.sparkSession) as scratch:
        lines = scratch.table(line_table(documents), "lines")
        firsts = lines.groupBy("a", "b").agg(F.min(place).alias("first"), F.count("*").alias("n"))
        judged = firsts.join(near, "a", "left").where("n > 1 or near")
        judged = judged.withColumn("near", F.coalesce("near", F.lit(False)))
        gone = lines.join(judged, ["a", "b"]).where(F.col("near") | (place != F.col("first")))
        return materialize(gone.select("doc_id", "mark", "line"), "repeated-lines")


def drop_repeats(documents: DataFrame) -> DataFrame:
    """The documents without the lines that go, and ``n_lines`` and ``n_dropped``; columns of these names are replaced."""
    added = ["n_lines", "n_dropped"]
    own = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c.lower() not in added])
    return _without_repeats(own, *added)


def _without_repeats(own: DataFrame, n_lines: str, n_dropped: str) -> DataFrame:
    """``own`` without the lines that go, and two counts under names that it does not have."""
    mark, dropped, key, of = free_names(own, "mark", "dropped", "key", "of")
    gone = repeats(own).groupBy("doc_id", "mark").agg(F.collect_set("line").alias(dropped))
    gone = gone.select(F.col("doc_id").alias(key), F.col("mark").alias(of), F.col(dropped))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    joined = own.withColumn(mark, F.hash(text))
    joined = joined.join(gone, (F.col("doc_id") == F.col(key)) & (F.col(mark) == F.col(of)), "left")
    parts = F.split(text, "\n", -1)
    kept = F.filter(parts, lambda _, i: ~F.array_contains(F.col(dropped), i))
    changed = F.when(F.col(dropped).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[changed.alias(c) if c == "text" else F.col(f"`{c}`") for c in own.columns],
        F.size(parts).cast("long").alias(n_lines),
        F.coalesce(F.size(dropped), F.lit(0)).cast("long").alias(n_dropped),
    )


def clean(documents: DataFrame) -> DataFrame:
    """The documents with their own columns, whatever their names, without the lines that go.

    A document that loses all its visible text goes with it; one that had none stays.
    """
    names = documents.columns
    n_lines, n_dropped = free_names(documents, "n_lines", "n_dropped")
    left = _without_repeats(documents, n_lines, n_dropped).where(F.col("text").rlike(r"\S") | (F.col(n_dropped) == 0))
    return left.select(*[F.col(f"`{c}`") for c in names])


def digest(documents: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    left = drop_repeats(documents.select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
