"""Encode categorical columns to label indexes and assemble feature vectors."""

from __future__ import annotations

import math

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.contract import FLIGHTS, Contract
from tarmac.operators.vocabulary import MAX_SMALL_LABELS, Size, Vocabulary

# A label with more rows than this part of an even shuffle partition is dealt over several. At most
# so many labels can be that frequent in a column, and never more than HOT_LABELS are told apart:
# beyond, a partition gets a 4096th of all rows by one label, which is no skew worth a copy.
HOT_PER_PARTITION = 4
HOT_LABELS = 4096
HOT_BYTES = 1024

# A sketch that tracks so many times the labels wanted errs by less than a quarter of the share that counts.
_TRACKED = 16

# Up to so many bytes of labels for each shuffle partition are hashed rather than sorted.
_HASHED_BYTES = 16 * 1024 * 1024


Hot = dict[str, dict[str, int]]  # by column, the hot labels and over how many parts each is dealt


def encode(df: DataFrame, *indexers: StringIndexerModel) -> DataFrame:
    """Apply fitted indexers as one pipeline; nothing is fitted again."""
    return PipelineModel(stages=list(indexers)).transform(df)


def _resolve(index: Column, column: str, unseen: str, n_labels: int) -> Column:
    if unseen == "keep":
        return F.coalesce(index, F.lit(float(n_labels)))
    message = F.concat(F.lit(f"unseen label in {column}: "), F.coalesce(F.col(column), F.lit("null")))
    return F.coalesce(index, F.raise_error(message).cast("double"))


def encode_join(
    df: DataFrame,
    vocabulary: Vocabulary,
    contract: Contract = FLIGHTS,
    unseen: str = "keep",
    max_labels: int = MAX_SMALL_LABELS,
    columns: list[str] | None = None,
    hot: Hot | None = None,
) -> DataFrame:
    """Encode by looking labels up in the vocabulary table, at any vocabulary size.

    A vocabulary whose measured size is small is broadcast, so the rows do not
    move; past that the rows are shuffled by label, hot labels in parts. ``unseen`` is
    ``keep`` (unseen and null labels get the number of labels) or ``error``. ``columns`` are
    the categorical columns to encode, by default all; ``hot`` is given if it was found before.

    With a shuffled vocabulary a sketch of ``df`` finds its hot labels, seen or not, in one pass that
    shuffles a few kilobytes a task; all lookups are one plan, and nothing is written. A stream cannot be
    read ahead, so labels that were hot in training count as hot there; within ``foreachBatch`` each batch
    has its own sketch.
    """
    columns = contract.categorical if columns is None else columns
    if hot is None:
        hot = find_hot(df, {c: vocabulary.sizes[c] for c in columns}, max_labels, vocabulary.table)
    for column in columns:
        output = contract.index_columns[column]
        labels = vocabulary.of(column).select("label", F.col("idx").alias(output))
        df = _looked_up(df, labels, column, output, vocabulary.sizes[column], hot.get(column))
        df = df.withColumn(output, _resolve(F.col(output), column, unseen, vocabulary.sizes[column].labels))
    return df


def find_hot(
    df: DataFrame, sizes: dict[str, Size], max_labels: int = MAX_SMALL_LABELS, trained: DataFrame | None = None
) -> Hot:
    """The hot labels of the columns whose labels are too many for a broadcast, all in one pass.

    Of a stream, those of the ``trained`` vocabulary's counts, if there is one.
    """
    large = [c for c, size in sizes.items() if not size.small(max_labels)]
    if not large:
        return {}
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not df.isStreaming:
        return hot_labels(df, large, partitions)
    return {c: {} for c in large} if trained is None else trained_hot_labels(trained, large, partitions)


def lookup(df: DataFrame, labels: DataFrame, column: str, output: str, size: Size, hot: Hot) -> DataFrame:
    """Adds ``output`` of the table ``label, output`` for the labels of a column; null where there is none.

    ``hot`` is what ``find_hot`` found for the column, among others.
    """
    return _looked_up(df, labels, column, output, size, hot.get(column))


def _looked_up(
    df: DataFrame, labels: DataFrame, column: str, output: str, size: Size, hot: dict[str, int] | None
) -> DataFrame:
    """By broadcast, or by a shuffle if the labels are too many for it and ``hot`` is given."""
    if hot is None:
        return _attach(df, F.broadcast(labels), column, output)
    return _attach_shuffled(df, labels, hot, size, column, output)


def _copies(counts: dict[str, int], total: int, partitions: int) -> dict[str, int]:
    """Over how many parts each label is dealt that has more than its share of one shuffle partition."""
    share = max(total / (HOT_PER_PARTITION * partitions), total / HOT_LABELS)
    return {label: math.ceil(n / share) for label, n in counts.items() if n > share}


def hot_labels(df: DataFrame, columns: list[str], partitions: int) -> dict[str, dict[str, int]]:
    """Per column the labels with more rows than a share of one shuffle partition, and how many such shares.

    One mergeable sketch of frequent items for each column: its size does not depend on the labels, and it
    misses none that is frequent. Labels longer than ``HOT_BYTES`` are left out.
    """
    wanted = min(HOT_PER_PARTITION * partitions, HOT_LABELS)
    short = [F.when(F.octet_length(c) <= HOT_BYTES, F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)]
    sketches = [
        part
        for i in range(len(columns))
        for part in (
            F.count(f"c{i}").alias(f"n{i}"),
            F.expr(f"approx_top_k(c{i}, {wanted}, {_TRACKED * wanted}) FILTER (WHERE c{i} IS NOT NULL)").alias(f"top{i}"),
        )
    ]
    row = df.select(*short).agg(*sketches).first()
    return {
        c: _copies({e["item"]: e["count"] for e in row[f"top{i}"] or []}, row[f"n{i}"], partitions)
        for i, c in enumerate(columns)
    }


def trained_hot_labels(table: DataFrame, columns: list[str], partitions: int) -> dict[str, dict[str, int]]:
    """As ``hot_labels``, from the counts of a vocabulary."""
    found = {}
    for column in columns:
        counts = table.where((F.col("field") == column) & (F.octet_length("label") <= HOT_BYTES))
        total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        most = counts.orderBy(F.desc("n"), "label").limit(HOT_LABELS).select("label", "n").collect()
        found[column] = _copies({r["label"]: r["n"] for r in most}, total, partitions)
    return found


def _attach(df: DataFrame, labels: DataFrame, column: str, output: str) -> DataFrame:
    joined = df.join(labels, df[column] == labels["label"], "left")
    return joined.select(*[df[c] for c in df.columns], labels[output])


def _attach_shuffled(
    df: DataFrame, labels: DataFrame, hot: dict[str, int], size: Size, column: str, output: str
) -> DataFrame:
    """Left lookup against a vocabulary too large to broadcast, safe for any label skew.

    The rows of a hot label are dealt over as many parts as it has shares, by a hash of the row, and the
    label's entry is there once for each part. Null labels need no lookup: such rows take part under a hash
    of the row, which scatters them, and a flag that no label has, so they meet nothing.
    """
    spark, columns = df.sparkSession, df.columns
    copies = spark.createDataFrame(list(hot.items()), "_hot string, _copies int")
    labels = labels.select(F.col("label").alias("_label"), F.lit(True).alias("_is_label"), output)
    one = F.coalesce("_copies", F.lit(1))
    if hot:
        df = df.join(F.broadcast(copies), F.col(f"`{column}`") == F.col("_hot"), "left")
        labels = labels.join(F.broadcast(copies), F.col("_label") == F.col("_hot"), "left")
        labels = labels.select("_label", "_is_label", output, F.explode(F.sequence(F.lit(0), one - 1)).alias("_of"))
    else:
        df, labels = df.withColumn("_copies", F.lit(None).cast("int")), labels.withColumn("_of", F.lit(0))
    scattered = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
    absent = F.col(f"`{column}`").isNull()
    probing = df.withColumns(
        {
            "_key": F.when(absent, scattered.cast("string")).otherwise(F.col(f"`{column}`")),
            "_looks_up": ~absent,
            "_part": F.pmod(scattered, one).cast("int"),
        }
    )
    pairs = (("_key", "_label"), ("_looks_up", "_is_label"), ("_part", "_of"))
    matched = [F.col(a) == F.col(b) for a, b in pairs]
    # the engine must not broadcast a table that may outgrow memory, whatever its estimate says
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = size.bytes <= _HASHED_BYTES * partitions
    joined = probing.join(labels.hint("shuffle_hash" if hashed else "merge"), matched, "left")
    return joined.select(*[F.col(f"`{c}`") for c in columns], output)


def assembler(contract: Contract = FLIGHTS) -> VectorAssembler:
    return VectorAssembler(inputCols=contract.features, outputCol=contract.vector)


def assemble(df: DataFrame, contract: Contract = FLIGHTS, invalid: str = "error") -> DataFrame:
    """Add the feature vector, slots in the contract's pinned order.

    ``invalid`` is ``error``, or ``keep`` to have missing numbers as NaN.
    """
    return assembler(contract).setHandleInvalid(invalid).transform(df)


def vector_slots(df: DataFrame, contract: Contract = FLIGHTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """The vector back as one double column per slot, for inspection and checks."""
    flat = df.select(*keep, vector_to_array(contract.vector).alias("_slots"))
    slots = [F.get("_slots", F.lit(i)).alias(f"slot_{i}") for i in range(len(contract.features))]
    return flat.select(*keep, *slots)
