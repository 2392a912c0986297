"""Line streams: a Kafka topic, or a directory of text files.

Both sides of a topic are described by option maps, so that a reader, a batch
writer and a stream writer of the same topic cannot disagree about its name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


@dataclass(frozen=True)
class Topic:
    servers: str
    name: str
    client: tuple[tuple[str, str], ...] = ()  # further client settings, such as those of a secured broker

    def _client(self) -> dict[str, str]:
        settings = {k if k.startswith("kafka.") else f"kafka.{k}": v for k, v in self.client}
        return {**settings, "kafka.bootstrap.servers": self.servers}

    def read_options(
        self,
        starting: str = "latest",
        max_records: int | None = None,
        min_partitions: int | None = None,
        group_prefix: str | None = None,
    ) -> dict[str, str]:
        """Offsets live in the query's checkpoint; ``starting`` counts for its first run only."""
        options = {
            **self._client(),
            "subscribe": self.name,
            "startingOffsets": starting,
        }
        if max_records is not None:
            options["maxOffsetsPerTrigger"] = str(max_records)
        if min_partitions is not None:
            options["minPartitions"] = str(min_partitions)
        if group_prefix is not None:
            options["groupIdPrefix"] = group_prefix
        return options

    def write_options(self) -> dict[str, str]:
        return {**self._client(), "topic": self.name}


def stream_topic(spark: SparkSession, topic: Topic, **limits) -> DataFrame:
    """The records of a topic as a ``value`` string column."""
    reader = spark.readStream.format("kafka").options(**topic.read_options(**limits))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def stream_text(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The lines of text files that appear under ``path``, as a ``value`` string column."""
    reader = spark.readStream
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def publish(lines: DataFrame, topic: Topic) -> None:
    """Send each row of a batch frame's ``value`` column as one record without a key."""
    lines.select("value").write.format("kafka").options(**topic.write_options()).save()


def paced(writer: DataStreamWriter, seconds: float | None) -> DataStreamWriter:
    """One micro-batch per interval (0: without pauses), or, without an interval, all there is and then stop."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def drain(query: StreamingQuery) -> None:
    """Let a stream of a source that ends deliver all it has, at its pace, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def to_topic(lines: DataFrame, topic: Topic, checkpoint: str, seconds: float | None = None) -> StreamingQuery:
    """Stream the ``value`` column to a topic. Delivery is at least once."""
    writer = lines.select("value").writeStream.format("kafka").options(**topic.write_options())
    return paced(writer.option("checkpointLocation", checkpoint), seconds).start()


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    seconds: float | None = None,
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
) -> StreamingQuery:
    """Stream to files. With a lasting checkpoint every row is written exactly once."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return paced(writer, seconds).start()
