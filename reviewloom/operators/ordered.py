"""Whole-table ordered scans without a single-partition window.

The rows are range partitioned once and written together with their partition
number.  Totals per partition are a table of one row per partition; adding the
totals of the earlier partitions to a running total inside each partition gives
the exact global answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewloom.session import written


def running_totals(df: DataFrame, order: Sequence[str], totals: Mapping[str, Column],
                   partitions: int | None = None) -> DataFrame:
    """Add inclusive running sums over the whole table in the given order.

    The order columns must be unique per row, so that range partitions stay even.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    staged = written(ranged, "ordered")
    sums = [F.sum(expr).alias(f"_sum_{name}") for name, expr in totals.items()]
    per_part = staged.groupBy("_part").agg(*sums)
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.select("_part", *[
        F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_before_{name}") for name in totals])
    # At most one row per range partition, hence safe to broadcast.
    placed = staged.join(F.broadcast(before), "_part")
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return placed.select(*df.columns, *[
        (F.sum(expr).over(inside) + F.col(f"_before_{name}")).alias(name) for name, expr in totals.items()])


def dense_index(df: DataFrame, column: str, index: str) -> DataFrame:
    """Distinct values of a column with a 0-based dense index in sorted order."""
    keys = df.filter(F.col(column).isNotNull()).select(column).distinct()
    numbered = running_totals(keys, [column], {index: F.lit(1)})
    return numbered.withColumn(index, (F.col(index) - 1).cast("bigint"))
