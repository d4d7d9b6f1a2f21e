"""Joins with one row per key in which a key that holds a large part of the rows is spread.

Spark splits a hot key of a join by itself only where nothing after the join relies on its
partitioning. Here both sides carry a salt besides the key: the rows one of a fixed number, the side
with a row per key all of them. Whatever follows by key adds up partial results of the parts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

# parts that the rows of a key are dealt to
PARTS = 64


def _part(df: DataFrame) -> Column:
    """A part that depends on the row and its place only, so that a task run again deals alike."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return F.pmod(F.xxhash64(*plain) + F.spark_partition_id(), F.lit(PARTS)).cast("int")


def join_split(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows with ``side``, which has one row per key and few of them beside the rows.

    ``how`` is inner, left, left_semi or left_anti. No part of a key has more than a small share of
    its rows, unless the rows are copies of each other in one partition.
    """
    keys, part = list(keys), "_part"
    while part in df.columns or part in side.columns:
        part = "_" + part
    every = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))
    return (df.withColumn(part, _part(df))
            .join(side.withColumn(part, every), [*keys, part], how).drop(part))
