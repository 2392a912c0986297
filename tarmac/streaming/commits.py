"""Scoring with both outputs of a batch committed at once, under the model that was in use when it began.

A batch is computed and written in one pass, its good and its dead rows, into a folder of the attempt at hand.
Then a small commit that names the attempt is put beside it in one step. Readers follow the commits, so a
crash between the two leaves nothing to be seen, and a batch that is repeated counts once.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tarmac.plans.training import LookupPipeline
from tarmac.session import deleted, listed, publish_text, published_text
from tarmac.sources.streams import paced
from tarmac.streaming.scoring import flatten_vectors

COMMIT = "query string, batch long, attempt string, version string, good long, dead long, schema string"


def score_all(routed: DataFrame, pipeline: PipelineModel | LookupPipeline) -> DataFrame:
    """Rows of ``route`` with predictions for the good ones, in one plan over one read of the batch.

    Dead rows pass through the model with numbers missing; what comes of it is put to null. Good rows do
    without their raw line.
    """
    kept = routed.columns
    if isinstance(pipeline, LookupPipeline):
        scored = pipeline.transform(routed, invalid="keep")
    else:
        stages = [s.copy().setHandleInvalid("keep") if isinstance(s, VectorAssembler) else s for s in pipeline.stages]
        scored = PipelineModel(stages=stages).transform(routed)
    scored, is_good = flatten_vectors(scored), F.col("route") == "good"
    made = {c: F.when(is_good, F.col(c)) for c in scored.columns if c not in kept}
    return scored.withColumns(made | {"value": F.when(~is_good, F.col("value"))})


def score_committed(
    routed: DataFrame,
    models,
    out: str,
    checkpoint: str,
    seconds: float | None = None,
    after: Callable[[DataFrame, dict], None] | None = None,
) -> StreamingQuery:
    """Score a stream of ``route`` into ``out``. ``models`` is a ``ModelStore`` or ``OneModel``.

    The version in use is read when a batch begins and written down first; a batch that is repeated after a
    failure takes the version it began with. ``after`` gets the committed rows and the commit of each batch;
    it is called again for a batch that is repeated.
    """
    out = out.rstrip("/")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        commit_path, folder = f"{out}/commits/{query}-{batch_id}.json", f"{out}/data/query={query}/batch={batch_id}"
        done = published_text(spark, commit_path)
        if done is None:
            if batch.isEmpty():
                return
            begun = f"{out}/begun/{query}-{batch_id}"
            version = published_text(spark, begun)
            if version is None:
                version = models.current()
                publish_text(spark, begun, version)
            counts, attempt = Observation(), f"{folder}/attempt={uuid.uuid4().hex}"
            rows = score_all(batch, models.load(version))
            schema = rows.schema.json()
            route = F.col("route")
            rows = rows.observe(counts, F.count_if(route == "good").alias("good"), F.count_if(route == "dead").alias("dead"))
            rows.write.partitionBy("route").parquet(attempt)
            commit = {"query": query, "batch": batch_id, "attempt": attempt.rsplit("=", 1)[1], "version": version, **counts.get, "schema": schema}
            publish_text(spark, commit_path, json.dumps(commit))
        else:
            commit = json.loads(done)
        for name in listed(spark, folder):  # what attempts before the committed one left
            if name != f"attempt={commit['attempt']}":
                deleted(spark, f"{folder}/{name}")
        if after:
            schema = T.StructType.fromJson(json.loads(commit["schema"]))
            after(spark.read.schema(schema).parquet(f"{folder}/attempt={commit['attempt']}"), commit)

    writer = routed.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


def read_commits(spark: SparkSession, out: str) -> DataFrame:
    """One row for each committed batch: its attempt, model version and numbers of good and dead rows."""
    return spark.read.schema(COMMIT).json(f"{out.rstrip('/')}/commits")


def read_committed(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all committed batches, ``route`` and the batch's ``query, batch, version`` beside them."""
    out = out.rstrip("/")
    commits = read_commits(spark, out)
    last = commits.orderBy(F.desc("batch")).select("schema").first()
    if last is None:
        return spark.createDataFrame([], "query string, batch long, route string, version string")
    fields = T.StructType.fromJson(json.loads(last["schema"])).fields
    folders = T.StructType.fromDDL("query string, batch long, attempt string, route string").fields
    schema = T.StructType([*[f for f in fields if f.name != "route"], *folders])
    rows = spark.read.schema(schema).parquet(f"{out}/data")
    return rows.join(commits.select("query", "batch", "attempt", "version"), ["query", "batch", "attempt"]).drop("attempt")
