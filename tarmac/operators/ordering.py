"""Running totals over a whole table, without bringing it to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.session import materialize


def running_totals(df: DataFrame, order: list[str], totals: dict[str, Column]) -> DataFrame:
    """Adds the sum of each of ``totals`` over all rows that come before a row.

    Range partitioning puts the rows in order; a sum is that within the range plus those of the ranges
    before. Only the ranges' sums, one row for each shuffle partition, meet in one task and are broadcast.
    ``order`` should tell rows apart: equal rows are summed in any order.
    """
    parted = df.withColumns({f"_own_{name}": column for name, column in totals.items()})
    parted = parted.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    parted = materialize(parted, "ordered")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = parted.groupBy("_range").agg(*[F.sum(f"_own_{name}").alias(f"_own_{name}") for name in totals])
    ranges = ranges.select(
        "_range", *[F.coalesce(F.sum(f"_own_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in totals]
    )
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = parted.join(F.broadcast(ranges), "_range")
    summed = {
        name: (F.col(f"_before_{name}") + F.coalesce(F.sum(f"_own_{name}").over(within), F.lit(0))).cast("long")
        for name in totals
    }
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], *[column.alias(name) for name, column in summed.items()])
