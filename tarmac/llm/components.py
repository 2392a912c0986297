"""Connected components of an edge table, by DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tarmac.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``; the component is its smallest node.

    Alternates the large-star and small-star steps, which take a number of rounds in the order of the
    logarithm of the number of nodes. Each round is written to the shared folder, so lineage stays short
    and a lost executor costs a reread. A node with a third of all edges is met in three ways: minima are
    combined before the shuffle, its edges in the join are split by the engine's skew handling, and the
    stars hang its neighbours on the minimum, so its edges are few after the first round.
    """
    now = materialize(_ordered(edges.select("a", "b")), "components")
    while True:
        large = _star(_both_ways(now), keep=F.col("v") > F.col("u"))
        small = materialize(_small(large), "components")
        settled = _fingerprint(small) == _fingerprint(now)
        now = small
        if settled:
            break
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    heads = now.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return roots.unionByName(heads)


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, smaller node first; loops go."""
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _both_ways(edges: DataFrame) -> DataFrame:
    ways = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                             F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    return edges.select(ways.alias("e")).select("e.u", "e.v")


def _star(pairs: DataFrame, keep) -> DataFrame:
    """Hangs neighbours ``v`` of ``u`` that ``keep`` takes on the smallest of ``u`` and its neighbours."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = pairs.where(keep).join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    return _ordered(hung)


def _small(edges: DataFrame) -> DataFrame:
    """Hangs every node and its smaller neighbours on the smallest of them."""
    downwards = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = downwards.groupBy("u").agg(F.min("v").alias("m"))
    joined = downwards.join(least, "u")
    hung = joined.select(F.col("m").alias("a"), F.col("v").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return _ordered(hung.unionByName(own))


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.crc32(F.concat_ws(" ", "a", "b")))).first())
