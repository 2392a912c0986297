"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: set[str] = set()  # folders of this process below the shared folder

# Runtime re-planning carries the skew handling of shuffled lookups, and a
# bounded number of open writers lets a partitioned sink skip its local sort.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; ``master`` is left to spark-submit by default."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it then gets a temporary
    folder, because driver and executors are the same process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-"))
        folder = spark.sparkContext.getCheckpointDir()
    if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        warnings.warn(f"spark.checkpoint.dir is {folder}: all executors must mount it as one shared folder", stacklevel=2)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing has used before."""
    path = f"{shared_folder(spark)}/tarmac-{purpose}-{uuid.uuid4().hex}"
    _WRITTEN.add(path)
    return path


def _located(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has run to its end: the writer marks that with a file of its own."""
    system, marker = _located(spark, f"{path.rstrip('/')}/_SUCCESS")
    return system.exists(marker)


def exists(spark: SparkSession, path: str) -> bool:
    system, located = _located(spark, path)
    return system.exists(located)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    system, located = _located(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(located)) if system.exists(located) else []


def deleted(spark: SparkSession, path: str) -> None:
    system, located = _located(spark, path)
    system.delete(located, True)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text at ``path`` in one step: a reader sees the whole of it, or what was there before."""
    jvm = spark.sparkContext._jvm
    system, draft = _located(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    target = system.makeQualified(jvm.org.apache.hadoop.fs.Path(path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(system.makeQualified(draft), target, options)


def published_text(spark: SparkSession, path: str) -> str | None:
    """What ``publish_text`` put at ``path``, or none."""
    system, located = _located(spark, path)
    if not system.exists(located):
        return None
    stream = system.open(located)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete_written(spark: SparkSession) -> None:
    """Delete what this process has written below the shared folder, once no frame refers to it any more."""
    while _WRITTEN:
        system, path = _located(spark, _WRITTEN.pop())
        system.delete(path, True)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as a shared table and return a scan of it.

    Cuts the lineage without tying the data to one executor: a lost executor
    costs a re-read of the table. The scan also has real size statistics.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Shared tables of one computation, deleted together when it ends and its result is stored elsewhere."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def table(self, df: DataFrame, purpose: str) -> DataFrame:
        """As ``materialize``."""
        path = fresh_folder(self.spark, purpose)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for name in self.paths:
            system, path = _located(self.spark, name)
            system.delete(path, True)
            _WRITTEN.discard(name)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a scan, or a kept frame, that has too few splits for them.

    Only an input of fewer than two splits per core is shuffled, so the cost is
    bounded by the cluster and not by the data; any larger input is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 2 * cores else df.repartition(cores)
