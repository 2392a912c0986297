"""Stream stages: parse, filter, score, dead-letter and per-batch callbacks.

Every stage takes and returns a DataFrame and is stateless, so each also works
on a batch frame; that is what makes batch and stream scoring agree.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.contract import FLIGHTS, Contract
from tarmac.operators.clean import drop_any_null, parse_lines, required_columns, with_validity
from tarmac.sources.streams import paced

Extra = dict[str, tuple[int, str]]


def parse_filter(
    lines: DataFrame,
    contract: Contract = FLIGHTS,
    require_label: bool = False,
    extra: Extra | None = None,
) -> DataFrame:
    """Typed rows of the lines that can be scored."""
    typed = parse_lines(lines, contract, extra=extra)
    return drop_any_null(typed, required_columns(contract, require_label))


def score(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``rawPrediction``, ``probability`` and ``prediction``."""
    return model.transform(rows)


def flatten_vectors(predictions: DataFrame) -> DataFrame:
    """Vector columns as arrays, for sinks and readers that know no vectors."""
    vectors = [f.name for f in predictions.schema.fields if f.dataType.typeName() == "vectorudt"]
    return predictions.withColumns({c: vector_to_array(c) for c in vectors})


def to_records(predictions: DataFrame) -> DataFrame:
    """Each prediction as one JSON text in a ``value`` column, for a topic."""
    return flatten_vectors(predictions).select(F.to_json(F.struct("*")).alias("value"))


def route(
    lines: DataFrame,
    contract: Contract = FLIGHTS,
    require_label: bool = False,
    extra: Extra | None = None,
) -> DataFrame:
    """All lines, typed, with ``route`` (``good`` or ``dead``), ``missing`` and the raw value.

    Written with ``partition_by=("route",)`` this feeds scoring and the dead-letter
    table from one read of the source and one exactly-once sink.
    """
    typed = parse_lines(lines, contract, keep=("value",), extra=extra)
    judged = with_validity(typed, contract, require_label)
    return judged.withColumn("route", F.when(F.col("is_valid"), "good").otherwise("dead")).drop("is_valid")


def each_batch(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    seconds: float | None = None,
) -> StreamingQuery:
    """Call ``handle(batch, batch_id)`` for every micro-batch that has rows.

    The batch is kept while the callback runs, since the emptiness test and the
    callback both read it. A batch is repeated after a failure, so the callback
    must be idempotent in ``batch_id``. Its errors stop the query.
    """

    def guarded(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if not batch.isEmpty():
                handle(batch, batch_id)
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(guarded).option("checkpointLocation", checkpoint)
    return paced(writer, seconds).start()


def write_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A callback that writes each batch to its own folder, so that a repeat replaces it.

    The folder also carries the id of the query, which lives in the checkpoint: a
    new checkpoint counts its batches from 0 again and must not replace older ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{path}/query_id={query}/batch_id={batch_id}")

    return write


def score_routed(
    model: PipelineModel,
    scored: Callable[[DataFrame, int], None],
    dead: Callable[[DataFrame, int], None],
    show: int = 0,
    publish: Callable[[DataFrame], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """A callback for batches of ``route``: predictions of the good rows, and the dead ones.

    The batch is held by ``each_batch``, so both outputs cost one read of the source.
    ``show`` prints that many good rows of every batch, and their predictions.
    ``publish`` gets the predictions as records; a repeated batch is published again.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        good = batch.where(F.col("route") == "good").drop("route", "missing", "value")
        predictions = flatten_vectors(score(good, model))
        scored(predictions, batch_id)
        dead(batch.where(F.col("route") == "dead").select("value", "missing"), batch_id)
        if publish:
            publish(to_records(predictions))
        if show:
            good.show(show)
            predictions.show(show)

    return handle
