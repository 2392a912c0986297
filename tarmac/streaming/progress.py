"""Counts of every batch of a stream, stored by a listener."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tarmac.session import exists, publish_text

METRIC = "routes"
RECORD = "query string, run string, batch long, good long, dead long, failed long, error string, started string"


def counted(routed: DataFrame) -> DataFrame:
    """The same rows, with their good and dead ones counted as they pass; for ``ProgressLog``."""
    good, dead = (F.count_if(F.col("route") == route).alias(route) for route in ("good", "dead"))
    return routed.observe(METRIC, good, dead)


class ProgressLog(StreamingQueryListener):
    """Stores a record for each batch of ``counted`` streams, and one for each run that fails.

    A batch that is repeated has the record of its last run, so the records add up to what an exactly-once
    sink holds. Add it with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _store(self, name: str, **record) -> None:
        publish_text(self.spark, f"{self.path}/{name}.json", json.dumps(record))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counts = progress.observedMetrics.get(METRIC)
        if counts is not None and progress.numInputRows:
            self._store(
                f"{progress.id}-{progress.batchId}",
                query=str(progress.id), run=str(progress.runId), batch=progress.batchId,
                good=counts["good"], dead=counts["dead"], failed=0, started=progress.timestamp,
            )

    def wait_for(self, query: str, batches: list[int], seconds: float = 60) -> None:
        """Until the records of these batches are stored; the engine tells a listener some time after a batch."""
        end = time.monotonic() + seconds
        while any(not exists(self.spark, f"{self.path}/{query}-{batch}.json") for batch in batches):
            if time.monotonic() > end:
                raise TimeoutError(f"no record of every batch of {query}")
            time.sleep(0.1)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self._store(f"{event.id}-failed-{event.runId}", query=str(event.id), run=str(event.runId), failed=1, error=event.exception[:2000])


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The stored records: counts for each batch, and runs that failed with their errors."""
    return spark.read.schema(RECORD).json(path)
