"""Merkle manifest of a table of documents, by a rollup of nested structs.

Every row is a leaf. The leaves of a source, in ascending order of their ids, form a tree of sixteen children
a node, and the roots of the sources, in the order of the sources, form one more. Ranks are found by range
partitioning; their base-16 digits become columns. Within blocks of bounded size the digits are grouped away
one after another, each group nesting the structs of its children, so that a block is one row that holds its
leaves and all hashes between. The roots of the blocks are ranked leaves again, of a table 256 times smaller,
until one is left of each tree. On the way down each block meets the steps above it, and exploding what is
nested gives every leaf its proof; no leaf is joined with anything.

A null value reads as ``-``, also in the leaf's hash; empty and long texts are hashed whole. Null ids come
first within a source, null sources first among the sources; a null id is never tampered with. Rows with the
same id and source stand in the order of their leaves, and repeated rows are leaves of their own, each with
its own place and proof. An empty table has no rows. Extra columns, of whatever name, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.session import materialize

#: Children of a node, as text is hashed: changing it changes every root.
FAN = 16

#: Digits that a block groups away: it holds at most ``FAN ** DIGITS`` nodes, whatever the table's size.
DIGITS = 2
BLOCK = FAN**DIGITS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_STEPS = "array<struct<before: string, after: string>>"


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(documents: DataFrame) -> DataFrame:
    """``tree, doc_id, hash, changed``: the leaf of every row, and of its tampered form where there is one.

    ``tree`` names the source; it sorts null sources first and the others by their bytes.
    """
    fields = [F.col(name) for name in FIELDS]
    lowered = [F.translate(c, _UPPER, _LOWER) if name == "text" else c for name, c in zip(FIELDS, fields, strict=True)]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return documents.select(
        F.coalesce(F.concat(F.lit(":"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long"),
        _hash(F.concat(*map(_encoded, fields))).alias("hash"),
        F.when(tampered, _hash(F.concat(*map(_encoded, lowered)))).alias("changed"),
    )


def ranked(nodes: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank``, a node's place in its tree from 0, and ``size``, the nodes of that tree.

    Range partitioning brings the nodes into order; a place is that within the range plus the sizes of the
    ranges before. Nodes that agree in everything are dealt over ranges as well.
    """
    dealt = nodes.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "salt")
    placed = dealt.sortWithinPartitions("tree", *order, "salt").withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed.withColumn("range", F.shiftright("at", 33)).drop("salt"), "manifest-order")
    tree, before = Window.partitionBy("tree"), Window.partitionBy("tree").orderBy("range")
    pieces = placed.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    pieces = pieces.select(
        "tree",
        "range",
        (F.sum("n").over(before) - F.col("n") - F.col("first")).alias("shift"),
        F.sum("n").over(tree).alias("size"),
    )
    return placed.join(pieces, ["tree", "range"]).withColumn("rank", F.col("at") + F.col("shift"))


def rolled(nodes: DataFrame) -> DataFrame:
    """Blocks of the nodes ``tree, rank, size, hash, payload``: one row each with its hash and, nested, its nodes.

    A tree of one node has no level above it, so its hash is passed on as it is.
    """
    digits = [(F.floor(F.col("rank") / FAN**k) % FAN).cast("int").alias(f"digit_{k}") for k in range(DIGITS)]
    block = F.floor(F.col("rank") / BLOCK).alias("block")
    frame = nodes.select("tree", "size", block, *digits, "hash", F.col("payload").alias("kids"))
    frame = frame.repartition("tree", "block")  # all that follows groups within these
    for level in range(DIGITS):
        left = [f"digit_{k}" for k in range(level + 1, DIGITS)]
        kid = F.struct(F.col(f"digit_{level}").alias("digit"), "hash", "kids")
        frame = frame.groupBy("tree", "size", "block", *left).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
        hashed = _hash(F.concat_ws("", F.col("kids.hash")))
        frame = frame.withColumn("hash", F.when(F.col("size") > FAN**level, hashed).otherwise(F.col("kids.hash")[0]))
    return frame


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The blocks of the nodes, the blocks of these blocks, and so on, until every tree is one block."""
    found = []
    while True:
        found.append(materialize(rolled(nodes), "manifest-blocks"))
        largest = found[-1].agg(F.max("size")).first()[0]
        if largest is None or largest <= BLOCK:
            return found
        up = F.ceil(F.col("size") / BLOCK).alias("size")
        nothing = F.lit(None).cast("boolean").alias("payload")
        nodes = found[-1].select("tree", F.col("block").alias("rank"), up, "hash", nothing)


def descended(blocks: list[DataFrame], above: DataFrame) -> DataFrame:
    """``payload, hash, steps, roots`` of the nodes that the first of the ``blocks`` were made of.

    ``above`` has ``tree, steps, roots`` of every tree. Steps go from a node up to the root: the hashes of
    the siblings before it and of those after it. A block meets the steps above it in a group, not a join.
    """
    above = above.select("tree", F.lit(0).cast("long").alias("rank"), F.struct("steps", "roots").alias("up"))
    for level_blocks in reversed(blocks):
        up_type = above.schema["up"].dataType
        down_type = level_blocks.schema["kids"].dataType
        below = level_blocks.select("tree", "block", "size", "kids", F.lit(None).cast(up_type).alias("up"))
        upper = above.select(
            "tree",
            F.col("rank").alias("block"),
            F.lit(None).cast("long").alias("size"),
            F.lit(None).cast(down_type).alias("kids"),
            "up",
        )
        met = below.unionByName(upper).groupBy("tree", "block")
        frame = met.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("size", "kids", "up")])
        frame = frame.select("tree", F.col("block").alias("rank"), "size", "kids", "up.steps", "up.roots")
        for level in reversed(range(DIGITS)):
            run = F.concat_ws("", F.col("kids.hash")).alias("run")
            kids = frame.select("tree", "rank", "size", "steps", "roots", run, F.posexplode("kids").alias("i", "kid"))
            step = F.expr("struct(substring(run, 1, 64 * i) AS before, substring(run, 64 * i + 65) AS after)")
            steps = F.when(F.col("size") > FAN**level, F.concat(F.array(step), "steps")).otherwise(F.col("steps"))
            rank = (F.col("rank") * FAN + F.col("kid.digit")).alias("rank")
            frame = kids.select("tree", rank, "size", "kid.hash", "kid.kids", steps.alias("steps"), "roots")
        above = frame.select("tree", "rank", F.struct("steps", "roots").alias("up"))
    return frame.select(F.col("kids").alias("payload"), "hash", "steps", "roots")


def proofs(documents: DataFrame) -> DataFrame:
    """``doc_id, leaf, changed, steps, subroot, root`` of every row.

    ``steps`` is the proof: for each level the hashes before and after the node on the leaf's way to the root.
    ``changed`` is the leaf of the tampered row, null for rows left alone.
    """
    ranks = ranked(materialize(leaves(documents), "manifest-leaves"), ["doc_id", "hash"])
    of_rows = rounds(ranks.select("tree", "rank", "size", "hash", F.struct("doc_id", "changed").alias("payload")))
    subroots = of_rows[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "hash")
    ranks = ranked(subroots, ["source"])
    of_sources = rounds(ranks.select("tree", "rank", "size", "hash", F.col("source").alias("payload")))
    top = of_sources[-1].select("tree", F.array().cast(_STEPS).alias("steps"), F.col("hash").alias("roots"))
    sources = descended(of_sources, top).select(
        F.col("payload").alias("tree"),
        "steps",
        F.struct(F.col("hash").alias("subroot"), F.col("roots").alias("root")).alias("roots"),
    )
    found = descended(of_rows, sources)
    return found.select(
        "payload.doc_id", F.col("hash").alias("leaf"), "payload.changed", "steps", "roots.subroot", "roots.root"
    )


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(steps, leaf, lambda below, step: _hash(F.concat(step["before"], below, step["after"])))


def digest(documents: DataFrame) -> DataFrame:
    """The proofs as one hash each, and whether the row at hand, tampered with or not, leads to the root."""
    siblings = F.transform("steps", lambda step: F.concat(step["before"], step["after"]))
    found = proofs(documents).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        _hash(F.concat_ws("", siblings)).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("steps")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
