"""Replay a stored table as a paced stream of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarmac.session import is_complete
from tarmac.sources.ordered import STRIDE, index_lines, save_index, stream_in_order
from tarmac.sources.streams import stream_text


def replay_in_order(
    spark: SparkSession, path: str, index: str, lines_per_trigger: int, stride: int = STRIDE
) -> DataFrame:
    """A stream ``line, value`` of the files' lines in their order, so many per micro-batch.

    The files are indexed unless they were before. A replay that is started again on the same index and
    checkpoint goes on with the line after the last one delivered, also within a file.
    """
    if not is_complete(spark, index):
        save_index(index_lines(spark, path, stride), index)
    return stream_in_order(spark, index, lines_per_trigger)


def stage(lines: DataFrame, path: str, lines_per_file: int) -> None:
    """Write the lines into files of at most ``lines_per_file``, without a shuffle.

    Each task cuts its own lines, in order, so staging scales with the table's
    splits and the pace below is set by the number of files per interval. What an
    earlier, unfinished staging left is replaced.
    """
    writer = lines.select("value").write.mode("overwrite")
    writer.option("maxRecordsPerFile", lines_per_file).text(path)


def replay(lines: DataFrame, path: str, lines_per_file: int, files_per_trigger: int) -> DataFrame:
    """A stream of ``files_per_trigger`` staged files per micro-batch; the lines are staged unless they were before.

    So a replay that is started again on the same folders goes on where its checkpoint says. Lines keep their
    order within a split only; ``replay_in_order`` keeps it throughout.
    """
    if not is_complete(lines.sparkSession, path):
        stage(lines, path, lines_per_file)
    return stream_text(lines.sparkSession, path, files_per_trigger)
