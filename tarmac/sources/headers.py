"""CSV files whose headers differ: columns by name, whatever their order in a file."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tarmac.sources.files import MAX_COLUMNS
from tarmac.sources.ordered import _located, _packed

# What reads the headers travels with the tasks, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Headers that may differ: each costs a scan of its own files.
MAX_HEADERS = 1000
_FILES_PER_TASK = 64


def headers(spark: SparkSession, path: str) -> DataFrame:
    """``file, length, header``: one row for each file at ``path``, its first line as an array of names.

    Only the first line of a file is read, by the executors. Empty files have no row.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    tasks = max(1, min(files.count() // _FILES_PER_TASK + 1, 10 * spark.sparkContext.defaultParallelism))

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_header(file) for file in batch["path"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["path"], batch["length"], pa.array(found, pa.list_(pa.string()))], names=["file", "length", "header"]
            )

    return files.repartition(tasks).mapInArrow(first_lines, "file string, length long, header array<string>")


def _header(file: str) -> list[str]:
    system, path = _located(quote(file, safe="/:@"))  # the listing has names as they are
    opened = system.open_input_stream(path, compression="detect") if _packed(path) else system.open_input_file(path)
    with opened as stream:
        text = io.TextIOWrapper(io.BufferedReader(stream, 1 << 16), "utf-8-sig", "replace", newline="")
        return next(csv.reader(text), [])


def read_csv_by_name(
    spark: SparkSession, path: str, columns: list[str] | None = None, max_columns: int = MAX_COLUMNS
) -> DataFrame:
    """Headered CSV files with every column a string, taken by name from each file.

    Files with the same header are one scan. ``columns`` must be in every file, and others are not read;
    without it all names of all headers are columns, null where a file lacks them. Of a name that a header
    has twice the first counts. Spark checks each file's header against the names again.
    """
    census = headers(spark, path).groupBy("header").agg(F.collect_list("file").alias("files")).orderBy(F.array_min("files"))
    kinds = [(tuple(r["header"]), sorted(r["files"])) for r in census.limit(MAX_HEADERS + 1).collect()]
    if len(kinds) > MAX_HEADERS:
        raise ValueError(f"more than {MAX_HEADERS} different headers at {path}")
    names = list(dict.fromkeys(name for header, _ in kinds for name in header)) if columns is None else columns
    parts = []
    for header, files in kinds:
        absent = [name for name in names if name not in header]
        if absent and columns is not None:
            raise ValueError(f"{files[0]} has no column {', '.join(absent)}")
        # places as names within, since a header may have one twice; the header's own line is skipped by Spark
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        reader = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
        scan = reader.option("maxColumns", max_columns).csv([_literal(file) for file in files])
        found = {name: F.col(f"c{i}") for i, name in reversed(list(enumerate(header)))}
        parts.append(scan.select(*[found.get(name, F.lit(None).cast("string")).alias(name) for name in names]))
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField(name, T.StringType()) for name in names]))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _literal(path: str) -> str:
    """A path whose characters stand for themselves where a pattern is expected."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)
