"""The lines of stored files as a stream in their own order, a number of lines for each micro-batch.

Spark indexes the files once: where the lines of every stretch begin, without moving a line. The stream's
offset is a place in that order, so a run that ends in the middle of a file goes on there, and each batch
opens only the stretches it needs.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tarmac.operators.ordering import running_totals

# The source travels with the tasks, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Lines of a stretch: a batch skips less than so many lines before its first one.
STRIDE = 10_000
#: Tasks of a batch for each core. Stretches that follow each other in a file are read by one task, up to so many lines.
_TASKS_PER_CORE, _LINES_PER_TASK = 2, 1_000_000
_ROWS = 8192  # lines of an Arrow batch


def index_lines(spark: SparkSession, path: str, stride: int = STRIDE) -> DataFrame:
    """``first, last, file, line, byte, skip`` of stretches of at most ``stride`` lines, in the order of the lines.

    Lines are numbered from 0 over the files in the order of their names; the first line of each file is its
    header and has no number. ``byte`` is where a stretch begins in its file, ``line`` its first line's number
    there, ``skip`` the lines to pass over. A line ends with a newline, and what is empty is a line, too.
    Each task counts its own lines; only the stretches are shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    size = (F.octet_length("value") + 1).cast("long")
    placed = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        size.alias("size"),
        F.monotonically_increasing_id().alias("at"),
    )
    stretches = placed.groupBy("file", "block", F.floor(F.col("at") / stride).alias("stretch")).agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("at").alias("at")
    )
    heads = stretches.groupBy(F.col("file").alias("name")).agg(F.min(F.struct("block", "at")).alias("head"))
    stretches = stretches.join(heads, F.col("file") == F.col("name"))
    stretches = stretches.withColumn("skip", (F.struct("block", "at") == F.col("head")).cast("long"))
    stretches = stretches.select("file", "block", "at", "n", "bytes", "skip")
    totals = {"lines": F.col("n"), "until": F.col("bytes"), "headers": F.col("skip")}
    summed = running_totals(stretches, ["file", "block", "at"], totals)
    begins = summed.where("skip = 1").select(
        F.col("file").alias("name"), F.col("until").alias("file_byte"), F.col("lines").alias("file_lines")
    )
    first = F.col("lines") - F.col("headers")
    index = summed.join(begins, F.col("file") == F.col("name")).select(
        first.alias("first"),
        (first + F.col("n") - F.col("skip")).alias("last"),
        "file",
        (F.col("lines") - F.col("file_lines") + F.col("skip") - 1).alias("line"),
        (F.col("until") - F.col("file_byte")).alias("byte"),
        "skip",
    )
    return index.where("first < last")


def save_index(index: DataFrame, path: str) -> None:
    """Store an index in the order of its lines, so that a batch reads a few of its parts only."""
    index.repartitionByRange("first").sortWithinPartitions("first").write.mode("overwrite").parquet(path)


@dataclass
class Stretch(InputPartition):
    """Lines ``first`` to ``first + count`` of the whole, found ``skip`` lines behind a byte of one file."""

    file: str
    byte: int
    skip: int
    first: int
    count: int


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path, and the path as it takes it."""
    scheme, sep, rest = uri.partition(":")
    if scheme == "file" and sep:
        return fs.LocalFileSystem(), "/" + unquote(rest).lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class OrderedLinesReader(DataSourceStreamReader):
    """Offsets count the lines delivered; they name the file and its line as well, for who reads a checkpoint."""

    def __init__(self, options: dict[str, str]):
        self.index, self.lines = options["path"], int(options["linespertrigger"])
        self.total, self.planned = int(options["total"]), None
        self.tasks = int(options.get("tasks", 1 << 62))

    def _stretches(self, start: int, end: int) -> list[dict]:
        system, path = _located(self.index)
        index = ds.dataset(path, filesystem=system, format="parquet", exclude_invalid_files=False)
        wanted = (ds.field("last") > start) & (ds.field("first") < end)
        return sorted(index.to_table(filter=wanted, use_threads=False).to_pylist(), key=lambda s: s["first"])

    def _offset(self, at: int) -> dict:
        """The place of line ``at``; behind the last line, that behind the last one."""
        found = self._stretches(max(0, min(at, self.total - 1)), at + 1)
        if not found:
            return {"at": at, "file": "", "line": 0}
        return {"at": at, "file": found[-1]["file"].rsplit("/", 1)[-1], "line": found[-1]["line"] + at - found[-1]["first"]}

    def initialOffset(self) -> dict:
        return self._offset(0)

    def latestOffset(self) -> dict:
        # after a restart the engine has planned its last batch anew by now, so what comes next is known
        self.planned = min(self.total, (self.planned or 0) + self.lines)
        return self._offset(self.planned)

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        self.planned = max(self.planned or 0, end["at"])
        planned = []
        share = min(-(-(end["at"] - start["at"]) // self.tasks), _LINES_PER_TASK)
        for s in self._stretches(start["at"], end["at"]) if start["at"] < end["at"] else []:
            first, last = max(s["first"], start["at"]), min(s["last"], end["at"])
            if planned and planned[-1].file == s["file"] and planned[-1].count + last - first <= share:
                planned[-1].count += last - first
            else:
                planned.append(Stretch(s["file"], s["byte"], s["skip"] + first - s["first"], first, last - first))
        return planned or [Stretch("", 0, 0, 0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.count:
            return
        system, path = _located(partition.file)
        with system.open_input_stream(path, compression="detect") if _packed(path) else system.open_input_file(path) as file:
            _forward(file, partition.byte)
            lines = io.BufferedReader(file, 1 << 20)
            for _ in range(partition.skip):
                lines.readline()
            first, left = partition.first, partition.count
            while left:
                n = min(left, _ROWS)
                texts = [lines.readline().rstrip(b"\n").removesuffix(b"\r").decode("utf-8", "replace") for _ in range(n)]
                numbers = pa.array(range(first, first + n), pa.int64())
                yield pa.RecordBatch.from_arrays([numbers, pa.array(texts, pa.string())], names=["line", "value"])
                first, left = first + n, left - n

    def commit(self, end: dict) -> None:
        pass


def _packed(path: str) -> bool:
    return path.rsplit(".", 1)[-1] in ("gz", "bz2", "lz4", "zst")


def _forward(file: pa.NativeFile, byte: int) -> None:
    """Go to a byte; a compressed file is read up to it."""
    if file.seekable():
        file.seek(byte)
        return
    while byte:
        byte -= len(file.read(min(byte, 1 << 20))) or byte


class OrderedLines(DataSource):
    """The streaming format ``ordered_lines``: the path of an index, ``linesPerTrigger`` and the ``total`` of lines.

    A batch has about as many ``tasks``, more if its files or stretches are more; without the option, one a stretch.
    """

    @classmethod
    def name(cls) -> str:
        return "ordered_lines"

    def schema(self) -> str:
        return "line bigint, value string"

    def streamReader(self, schema) -> OrderedLinesReader:
        return OrderedLinesReader({k.lower(): v for k, v in self.options.items()})


def stream_in_order(spark: SparkSession, index: str, lines_per_trigger: int) -> DataFrame:
    """``line, value`` of indexed files as a stream of so many lines per micro-batch, the first ones first."""
    total = spark.read.parquet(index).agg(F.coalesce(F.max("last"), F.lit(0))).first()[0]
    spark.dataSource.register(OrderedLines)
    reader = spark.readStream.format(OrderedLines.name()).option("linesPerTrigger", lines_per_trigger)
    tasks = _TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return reader.option("total", total).option("tasks", tasks).load(index)

