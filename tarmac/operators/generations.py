"""A vocabulary that grows: counts of labels in generations, merged when they are numbered, compacted now and then.

Counts of new rows are added as a generation of their own; no older row is counted again. Which generations
count stands in one small text that is replaced in one step, so a reader sees all of an addition or none.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tarmac.contract import FLIGHTS, Contract
from tarmac.operators.vocabulary import MAX_SMALL_LABELS, Vocabulary, count_labels, measure, rank_labels
from tarmac.session import deleted, listed, materialize, publish_text, published_text

#: More generations than this are merged into one.
MOST = 8
_POINTER, _COUNTS = "GENERATIONS", "field string, label string, n bigint"


class GrowingVocabulary:
    """Label counts below a path. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str, contract: Contract = FLIGHTS):
        self.spark, self.path, self.contract = spark, path.rstrip("/"), contract

    def generations(self) -> list[dict]:
        """``folder`` and ``names`` (what was added, as its callers called it) of those that count, oldest first."""
        text = published_text(self.spark, f"{self.path}/{_POINTER}")
        return json.loads(text) if text else []

    def add(self, rows: DataFrame, name: str, most: int = MOST) -> bool:
        """Count the labels of new rows; false, and nothing is done, if rows of that name were added before."""
        now = self.generations()
        if any(name in g["names"] for g in now):
            return False
        now.append({"folder": self._write(count_labels(rows, self.contract.categorical)), "names": [name]})
        self._publish(now)
        if len(now) > most:
            self.compact()
        return True

    def counts(self) -> DataFrame:
        """``field, label, n`` over all generations; partial sums are taken before anything is shuffled."""
        folders = [f"{self.path}/{g['folder']}" for g in self.generations()]
        if not folders:
            return self.spark.createDataFrame([], _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(*folders).groupBy("field", "label").agg(F.sum("n").alias("n"))

    def compact(self) -> None:
        """Merge all generations into one; the folders merged before the last time are deleted."""
        now = self.generations()
        merged = {"folder": self._write(self.counts()), "names": [name for g in now for name in g["names"]]}
        self._publish([merged])
        kept = {merged["folder"], *[g["folder"] for g in now]}  # for who reads them still
        for folder in listed(self.spark, self.path):
            if folder.startswith("counts-") and folder not in kept:
                deleted(self.spark, f"{self.path}/{folder}")

    def fit(self, max_labels: int = MAX_SMALL_LABELS) -> Vocabulary:
        """The vocabulary of all rows added so far, numbered as ``fit_vocabulary`` would."""
        counts = materialize(self.counts(), "merged-counts")
        sizes = measure(counts, self.contract.categorical)
        return Vocabulary(materialize(rank_labels(counts, sizes, max_labels), "vocabulary"), sizes)

    def _write(self, counts: DataFrame) -> str:
        folder = f"counts-{uuid.uuid4().hex}"
        counts.write.parquet(f"{self.path}/{folder}")
        return folder

    def _publish(self, generations: list[dict]) -> None:
        publish_text(self.spark, f"{self.path}/{_POINTER}", json.dumps(generations))
