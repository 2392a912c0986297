"""Document fingerprints of improbable features.

Every window of 64 bytes has an entropy; how rare this entropy is among all windows of all documents ranks
the window. A window that is the rarest (leftmost at ties) in many runs of 64 neighbouring windows is a
feature. Features go, in order, into a chain of Bloom filters of 2048 bits with 160 features each, and two
fingerprints are as like as their filters overlap beyond chance.

A text shorter than a window is one feature, and an empty text (null too) none; a text always has the same
fingerprint. Two empty fingerprints are alike (1), an empty and another are not (0). Documents follow each
other by id, then by text where ids repeat; a null id comes first. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.buffers import BLOCK_BYTES, Block, blocks, group_starts, ranges, stretch_hashes

FEATURE = 64
RUN = 64
POPULAR = 16
PER_FILTER = 160
BITS = 2048
HASHES = 5
LEVELS = 1001  # of entropy
LEAST_LEVEL = 100  # windows below are too plain to be features

_SCALE = 1 << 16
_TERMS = np.zeros(FEATURE + 2, np.int64)
_TERMS[1:] = np.round(np.arange(1, FEATURE + 2) * np.log2(np.arange(1, FEATURE + 2)) * _SCALE)
_MOST = FEATURE * 6 * _SCALE  # of a window of one byte value
_SLICE = 1 << 16  # bytes that are compared while they stay in the cache


def levels(data: np.ndarray) -> np.ndarray:
    """Entropy level, 0 to 1000, of every window of 64 bytes."""
    n = len(data) - FEATURE + 1
    if n <= 0:
        return np.empty(0, np.int64)
    ahead, behind = np.ones(len(data), np.uint8), np.ones(len(data), np.uint8)
    for at in range(0, len(data), _SLICE):
        end = min(at + _SLICE, len(data))
        for d in range(1, FEATURE):
            upto = min(end, len(data) - d)
            if upto <= at:
                break
            same = (data[at:upto] == data[at + d : upto + d]).view(np.uint8)
            ahead[at:upto] += same
            behind[at + d : upto + d] += same
    # moving on by one byte takes one of the first byte's value away and adds one of the next byte's
    left, entered = ahead[: n - 1], behind[FEATURE:]
    gain = np.diff(_TERMS, prepend=0)
    total = np.empty(n, np.int64)
    total[0] = _TERMS[np.bincount(data[:FEATURE], minlength=256)].sum()
    total[1:] = gain[entered] - gain[left]
    np.cumsum(total, out=total)
    return (LEVELS - 1) - total * (LEVELS - 1) // _MOST


def _positions(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie within a text, and how many each text has."""
    counts = np.maximum(block.lengths - FEATURE + 1, 0)
    return ranges(block.starts, counts), counts


def level_counts(documents: DataFrame) -> np.ndarray:
    """How many windows of all documents have each level: one row per task and level reaches the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LEVELS, np.int64)
        for batch in batches:
            for block in blocks(batch["text"]):
                total += np.bincount(levels(block.data)[_positions(block)[0]], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS, dtype=np.int32)), pa.array(total)], ["level", "n"])

    rows = documents.select(F.col("text").cast("string")).mapInArrow(counted, "level int, n long")
    found = np.zeros(LEVELS, np.int64)
    for row in rows.groupBy("level").agg(F.sum("n").alias("n")).collect():
        found[row["level"]] = row["n"]
    return found


def rarity(counts: np.ndarray) -> np.ndarray:
    """Rank of every level, the rarest first; levels that are too plain come last."""
    order = np.lexsort((np.arange(LEVELS), counts, np.arange(LEVELS) < LEAST_LEVEL))
    ranks = np.empty(LEVELS, np.int64)
    ranks[order] = np.arange(LEVELS)
    return ranks


def features(block: Block, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features in order, without repeats, and the text of each."""
    where, counts = _positions(block)
    level = levels(block.data)[where]
    keys = (ranks[level].astype(np.uint64) << np.uint64(32)) | np.arange(len(where), dtype=np.uint64)
    first = np.cumsum(counts) - counts
    # the leftmost rarest of every run that lies within a text
    least, reach = keys, 1
    while reach < RUN:
        least = np.minimum(least[:-reach], least[reach:]) if len(least) > reach else least[:0]
        reach *= 2
    runs = ranges(first, np.maximum(counts - RUN + 1, 0))
    chosen = (least[runs] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    popular = np.bincount(chosen, minlength=len(where)) >= POPULAR
    popular &= level >= LEAST_LEVEL
    text = np.repeat(np.arange(len(block)), counts)
    # a text without a popular window has its rarest one
    some = np.bincount(text[popular], minlength=len(block)) > 0
    none = np.flatnonzero((counts > 0) & ~some)
    if len(none):
        own = ranges(first[none], counts[none])
        rarest = np.minimum.reduceat(keys[own], np.cumsum(counts[none]) - counts[none])
        popular[(rarest & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
    picked = np.flatnonzero(popular)
    short = np.flatnonzero((block.lengths > 0) & (counts == 0))
    begin = np.concatenate([where[picked], block.starts[short]])
    end = np.concatenate([where[picked] + FEATURE, block.ends[short]])
    owner = np.concatenate([text[picked], short])
    (hashes,) = stretch_hashes(block.data, begin, end)
    order = np.lexsort((begin, hashes, owner))
    order = order[group_starts(owner[order], hashes[order])]
    order = order[np.lexsort((begin[order], owner[order]))]
    return hashes[order], owner[order]


def filters(block: Block, ranks: np.ndarray) -> list[np.ndarray]:
    """The chain of every text: filters x bits."""
    hashes, owner = features(block, ranks)
    counts = np.bincount(owner, minlength=len(block))
    chained = -(-counts // PER_FILTER)
    base = np.cumsum(chained) - chained
    index = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    row = base[owner] + index // PER_FILTER
    bits = np.zeros((int(chained.sum()), BITS), bool)
    for k in range(HASHES):
        bits[row, ((hashes >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
    return [bits[b : b + c] for b, c in zip(base, chained, strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Mean, over the filters of the shorter chain, of the best overlap beyond chance with the other's filters."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0.0 if len(b) else 1.0
    sizes, best = b.sum(axis=1), []
    other = b.astype(np.float32)
    for part in np.array_split(a, -(-len(a) // 256)):
        own = part.sum(axis=1)[:, None]
        chance = own * sizes / BITS
        room = np.minimum(own, sizes) - chance
        over = (part.astype(np.float32) @ other.T - chance) / np.maximum(room, 1e-9)
        best.append(np.clip(over, 0, 1).max(axis=1))
    return float(np.concatenate(best).mean())


def as_text(chain: np.ndarray) -> str:
    return np.packbits(chain, axis=1).tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    packed = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, BITS // 8)
    return np.unpackbits(packed, axis=1).astype(bool)


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return filters(Block(np.frombuffer(b"".join(texts), np.uint8), bounds, 0), ranks)


def in_order(documents: DataFrame) -> DataFrame:
    """``bucket, ghost, doc_id, text``, sorted within partitions by these columns in this order.

    The documents are cut by id into buckets at ids that the documents have. The first document of each
    bucket comes again, as a ghost, at the end of the bucket before it, and the first of all at the end of
    the last. So every document but a ghost is followed by its next one, and texts are shuffled once.
    """
    spark = documents.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = documents.select(
        order.alias("id"), F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    shares = [i / parts for i in range(1, parts)]
    cut = rows.agg(F.min("id").alias("least"), F.percentile_approx("id", shares or [0.5], 100 * parts).alias("at")).first()
    bounds = sorted({x for x in (cut["at"] or []) if x > cut["least"]}) if parts > 1 else []
    if not bounds:
        numbered = rows.select("*", F.lit(0).alias("bucket"), F.lit(None).cast("int").alias("before"))
    else:
        # a search in two steps, as there may be many bounds
        width = int(len(bounds) ** 0.5) + 1
        rungs = [bounds[i : i + width] for i in range(0, len(bounds), width)]
        ladder = F.array(*[F.array(*[F.lit(x) for x in rung]) for rung in rungs])
        heads = F.array(*[F.lit(rung[0]) for rung in rungs])
        rung = F.size(F.filter(heads, lambda x: x <= F.col("id")))
        step = F.size(F.filter(F.element_at(ladder, F.col("rung")), lambda x: x <= F.col("id")))
        numbered = (
            rows.withColumn("rung", rung)
            .withColumn("step", F.when(F.col("rung") > 0, step).otherwise(0))
            .withColumn("bound", F.when(F.col("rung") > 0, F.element_at(F.element_at(ladder, F.col("rung")), F.col("step"))))
            .withColumn("bucket", F.when(F.col("rung") > 0, (F.col("rung") - 1) * width + F.col("step")).otherwise(0))
            .withColumn("before", F.when(F.col("id") == F.col("bound"), F.col("bucket") - 1))
        )
    last = len(bounds)
    before = F.when(F.col("id") == F.lit(cut["least"]), last).otherwise(F.col("before"))
    places = F.array_compact(
        F.array(
            F.struct(F.col("bucket").cast("int").alias("bucket"), F.lit(False).alias("ghost")),
            F.when(before.isNotNull(), F.struct(before.cast("int").alias("bucket"), F.lit(True).alias("ghost"))),
        )
    )
    placed = numbered.select(F.explode(places).alias("at"), "id", "doc_id", "text")
    placed = placed.select("at.bucket", "at.ghost", "id", "doc_id", "text")
    return placed.repartition(parts, "bucket").sortWithinPartitions("bucket", "ghost", "id", "text").drop("id")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_NAMES = [field.split()[0] for field in SCHEMA.split(", ")]


def compare_with_edits(documents: DataFrame, ranks: np.ndarray) -> DataFrame:
    """Each document's fingerprint against those of its next document and of itself with that one's head as its tail."""

    def results(rows: list[tuple[int, bool, int, str]]) -> pa.RecordBatch:
        """For all rows but the last and the ghosts; each is followed by its next document."""
        own = fingerprints([text.encode() for *_, text in rows], ranks)
        real = [i for i, (_, ghost, *_) in enumerate(rows[:-1]) if not ghost]
        edited = []
        for i in real:
            text, after = rows[i][3], rows[i + 1][3]
            tail = len(text) // 4
            edited.append((text[: len(text) - tail] + after[:tail]).encode())
        columns: list[list] = [[] for _ in _NAMES]
        for i, text, chain in zip(real, edited, fingerprints(edited, ranks), strict=True):
            row = (
                rows[i][2],
                len(rows[i][3]),
                hashlib.sha256(text).hexdigest(),
                as_text(own[i]),
                as_text(chain),
                likeness(own[i], chain),
                likeness(own[i], own[i + 1]),
            )
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_NAMES)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bool, int, str]] = []
        size = 0
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                held.append(row)
                size += len(row[3])
                if size > BLOCK_BYTES // 2 and len(held) > 1:
                    yield results(held)
                    held, size = held[-1:], len(held[-1][3])
        if len(held) > 1:
            yield results(held)

    return in_order(documents).mapInArrow(compared, SCHEMA)


def digest(documents: DataFrame) -> DataFrame:
    return compare_with_edits(documents, rarity(level_counts(documents)))
