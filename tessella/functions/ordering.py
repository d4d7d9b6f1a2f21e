"""Consecutive numbers in a given order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tessella.frame import col
from tessella.runtime import cut_lineage


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The rows with their number from 0 in the order of the given columns, which tell all rows apart.

    Rows are range-partitioned and written once; a partition counts on from what is before it. Only
    the partitions' sizes meet in one place.
    """
    cols = [col(c) for c in order]
    parts = cut_lineage(df.repartitionByRange(*cols).withColumn("_part", F.spark_partition_id()))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*cols)) - 1
    return (parts.join(offsets, "_part").withColumn(name, (F.col("_before") + place).cast("long"))
            .drop("_part", "_before"))
