"""Every row against every row of another matrix, block by block.

Rows are hashed into blocks of bounded size; each pair of blocks is one group whose two sides meet
in a cogrouped Arrow function. What a pair emits is up to the function: sums, the k best, or the
cells of a result that is itself a matrix. Rows are never paired up as Spark rows. With B blocks
each row is sent B times, so blocks are as large as a task can hold.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessella.errors import NotUniqueError
from tessella.frame import col, double, id_of, value_columns
from tessella.runtime import cut_lineage

BLOCK_BYTES = 64 * 2**20


def vectors(df: DataFrame, id_col: str | None = None, cols: list[str] | None = None) -> DataFrame:
    """``id string, vec array<double>`` from a wide matrix."""
    id_col = id_of(df, id_col)
    cols = cols or value_columns(df, id_col)
    return df.select(col(id_col).cast("string").alias("id"),
                     F.array(*[double(c) for c in cols]).alias("vec"))


def prepared(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows, written once to the checkpoint folder, and their number.

    Every block is read many times, and what leads to the rows should run once. Ids have to be
    unique, since a repeated id would fill one block.
    """
    rows = cut_lineage(rows)
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids")).first()
    if found["ids"] != found["n"]:
        raise NotUniqueError("row ids must be unique and present")
    return rows, found["n"]


# rows below which a block isn't cut further for the sake of more tasks
LEAST_ROWS = 128


def block_count(rows: int, width: int, block_rows: int | None = None,
                most_rows: int | None = None) -> int:
    """Blocks to cut the rows into: bounded in bytes, and enough to give every core a pair of them.

    ``block_rows`` fixes the rows of a block, ``most_rows`` bounds them besides the bytes.
    """
    if block_rows:
        return max(1, -(-rows // block_rows))
    bound = max(1, BLOCK_BYTES // (8 * max(1, width)))
    bound = min(bound, most_rows or bound)
    cores = SparkSession.active().sparkContext.defaultParallelism
    spread = min(math.ceil(math.sqrt(2 * cores)), rows // LEAST_ROWS)
    return max(1, -(-rows // bound), spread)


def _block(blocks: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")


def pair_blocks(left: DataFrame, right: DataFrame, left_blocks: int, right_blocks: int,
                fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
                blocks: tuple[Column, Column] | None = None) -> DataFrame:
    """Run ``fn(left, right)`` on each pair of a left and a right block.

    Rows fall into blocks by their id, or by the two given column expressions.
    """
    mine, theirs = blocks or (_block(left_blocks), _block(right_blocks))
    a = left.withColumn("_a", mine).withColumn("_b", _all_blocks(right_blocks))
    b = right.withColumn("_b", theirs).withColumn("_a", _all_blocks(left_blocks))
    return _cogroup(a, b, lambda key, x, y: fn(x, y), schema)


def _all_blocks(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def pair_own_blocks(rows: DataFrame, blocks: int,
                    fn: Callable[[pa.Table, pa.Table, bool], pa.Table], schema: str) -> DataFrame:
    """Run ``fn(left, right, same)`` on each unordered pair of blocks of one matrix.

    ``same`` tells that a block meets itself.
    """
    own = rows.withColumn("_own", _block(blocks))
    a = (own.withColumn("_a", F.col("_own")).withColumn(
        "_b", F.explode(F.sequence(F.col("_a"), F.lit(blocks - 1)))).drop("_own"))
    b = (own.withColumn("_b", F.col("_own")).withColumn(
        "_a", F.explode(F.sequence(F.lit(0), F.col("_b")))).drop("_own"))
    return _cogroup(a, b, lambda key, x, y: fn(x, y, key[0].as_py() == key[1].as_py()), schema)


def _cogroup(a: DataFrame, b: DataFrame, fn, schema: str) -> DataFrame:
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0 or right.num_rows == 0:
            return arrow.empty_table()
        return fn(key, left, right).cast(arrow)

    # both sides may come from one frame; new names for the same columns keep them apart
    b = b.select(*[F.col(c).alias(c) for c in b.columns])
    return a.groupBy("_a", "_b").cogroup(b.groupBy("_a", "_b")).applyInArrow(meet, schema)
