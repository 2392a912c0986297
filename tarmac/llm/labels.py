"""What the trained operators share: who is held out, and a bounded sample to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by the checksum of their id, is never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learning_sample(documents: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``bound`` labelled documents that are not held out.

    ``bound`` is the documented limit of what a model is fitted on: the labelled ids with the smallest
    hashes are taken, so the sample is the same for any partitioning. Ids with contradicting labels count
    with the larger one. The ids are broadcast: ``bound`` rows of two numbers at most.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = (
        known.groupBy("doc_id")
        .agg(F.max(F.col(label)).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(bound)
    )
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
