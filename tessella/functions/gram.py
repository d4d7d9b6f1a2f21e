"""Masked cross-product sums of matrix columns, in one pass over the rows.

For two columns x and y the sums over the rows where both are present (n, Σx, Σy, Σx², Σy², Σxy)
give every pairwise statistic. Columns are cut into blocks; each task multiplies its Arrow batches with
numpy and emits one value per pair of blocks, the array of its sums. Arrays are added up in a tree, so
neither rows nor single cells are paired in Spark. More pairs of blocks than a task can hold are dealt
to several tasks, which get the rows from one scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col, double

BLOCK = 512
# block pairs one task keeps sums for: 40 * 6 * 512^2 doubles, about 0.5 GB
PAIRS_PER_PASS = 40
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def column_means(df: DataFrame, cols: list[str]) -> Column:
    """Means of the columns as one scalar subquery (array in column order)."""
    return df.agg(F.array(*[F.avg(double(c)) for c in cols]).alias("m")).scalar()


def block_sums(df: DataFrame, x_cols: list[str], y_cols: list[str] | None = None,
               shift: bool = True, keys: list[str] | None = None,
               means_from: DataFrame | None = None, block: int = BLOCK,
               pairs_per_pass: int = PAIRS_PER_PASS) -> DataFrame:
    """``keys…, a, b, sums``: the sums of block a of x and block b of y as one binary value of doubles.

    Without ``y_cols`` the pairs are those of x with a <= b. With ``shift`` the column means are
    taken off first, so that the sums of squares do not cancel. A task holds the sums of
    ``pairs_per_pass`` pairs of blocks. ``keys`` (few distinct values) keep separate sums. ``means_from``
    is a smaller frame with the same columns to shift by.
    """
    same = y_cols is None
    y_cols = x_cols if same else y_cols
    keys = keys or []
    source = df if means_from is None else means_from
    if shift:
        # as columns, so that each subquery stands in the plan once
        df = df.withColumn("_mx", column_means(source, x_cols))
        df = df if same else df.withColumn("_my", column_means(source, y_cols))

    def cells(cols, means, b):
        part = range(b * block, min((b + 1) * block, len(cols)))
        return F.array(*[double(cols[k]) - F.col(means)[k] if shift else double(cols[k])
                         for k in part])

    xs, ys = range(-(-len(x_cols) // block)), range(-(-len(y_cols) // block))
    pairs = [(a, b) for a in xs for b in ys if not same or a <= b]
    passes = [pairs[k:k + pairs_per_pass] for k in range(0, len(pairs), pairs_per_pass)]
    narrow = df.select(*[col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)],
                       *[cells(x_cols, "_mx", a).alias(f"x{a}") for a in xs],
                       *([] if same else [cells(y_cols, "_my", b).alias(f"y{b}") for b in ys]))
    if len(passes) > 1:
        narrow = _fanned_out(narrow, passes, same)
    names = [f"k{i}" for i in range(len(keys))]
    ddl = "".join(f"{k} string, " for k in names) + "a int, b int, sums binary"
    parts = narrow.mapInArrow(_summer(passes, names, same), ddl).withColumn("_task", F.spark_partition_id())
    # a sum of a pair of whole blocks takes 12 MB, so few of them are added in one place
    width = min(block, max(len(x_cols), len(y_cols)))
    fan = max(16, 2**28 // (8 * len(SUMS) * width * width))
    for level in range(1, 2 if fan >= 256 else 3):
        parts = (parts.groupBy(*names, "a", "b", F.floor(F.col("_task") / fan**level).cast("int").alias("_up"))
                 .applyInArrow(added, ddl + ", _task int"))
    whole = parts.groupBy(*names, "a", "b").applyInArrow(added, ddl + ", _task int").drop("_task")
    return whole.withColumnsRenamed({n: k for n, k in zip(names, keys)})


def _fanned_out(narrow: DataFrame, passes: list[list[tuple[int, int]]], same: bool) -> DataFrame:
    """Every row once per pass, with the blocks that the pass needs, the rows of a pass together."""
    def needed(name: str) -> list[int]:
        side, number = name[0], int(name[1:])
        return [k for k, chunk in enumerate(passes) if any(
            number == a and side == "x" or number == b and (same or side == "y") for a, b in chunk)]

    deal = F.pmod(F.xxhash64(*narrow.columns), F.lit(narrow.sparkSession.sparkContext.defaultParallelism))
    every = F.explode(F.sequence(F.lit(0), F.lit(len(passes) - 1)))
    rows = narrow.select("*", deal.alias("_deal"), every.alias("_pass"))
    blocks = [F.when(F.col("_pass").isin(needed(c)), F.col(c)).alias(c) if c[0] in "xy" else F.col(c)
              for c in narrow.columns]
    return (rows.select(*blocks, "_deal", "_pass").repartition("_pass", "_deal").drop("_deal")
            .sortWithinPartitions("_pass"))


def cross_sums(df: DataFrame, x_cols: list[str], y_cols: list[str] | None = None,
               shift: bool = True, keys: list[str] | None = None,
               means_from: DataFrame | None = None, block: int = BLOCK,
               pairs_per_pass: int = PAIRS_PER_PASS) -> DataFrame:
    """``keys…, i, j, n, sx, sy, sxx, syy, sxy`` for column numbers i of x and j of y: the cells of
    ``block_sums``, a row each."""
    whole = block_sums(df, x_cols, y_cols, shift, keys, means_from, block, pairs_per_pass)
    same, keys = y_cols is None, keys or []
    nx, ny = len(x_cols), len(x_cols if same else y_cols)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                i, j, found = _cells_of(row, nx, ny, same, block)
                data = {k: pa.array([row[k]] * len(i), pa.string()) for k in keys}
                data |= {"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32())}
                yield pa.RecordBatch.from_pydict(data | {s: pa.array(v) for s, v in zip(SUMS, found)})

    ddl = "".join(f"`{k}` string, " for k in keys)
    return whole.mapInArrow(cut, f"{ddl}i int, j int, " + ", ".join(f"{s} double" for s in SUMS))


def _cells_of(row: dict, nx: int, ny: int, same: bool, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column numbers and sums of the cells of a pair of blocks; of equal columns only i <= j."""
    a, b = row["a"] * block, row["b"] * block
    shape = (min(block, nx - a), min(block, ny - b))
    i, j = (v.ravel() for v in np.indices(shape))
    found = np.frombuffer(row["sums"]).reshape(len(SUMS), -1)
    keep = (i + a <= j + b) if same else np.ones(len(i), bool)
    return (i + a)[keep], (j + b)[keep], found[:, keep]


def gram_arrays(df: DataFrame, x_cols: list[str], y_cols: list[str] | None = None,
                block: int = BLOCK, **options) -> dict[str, np.ndarray]:
    """The sums as one array each on the driver, columns by columns, from one value per pair of blocks."""
    same = y_cols is None
    nx, ny = len(x_cols), len(x_cols if same else y_cols)
    out = {s: np.zeros((nx, ny)) for s in SUMS}
    for row in block_sums(df, x_cols, y_cols, block=block, **options).toLocalIterator():
        i, j, found = _cells_of(row.asDict(), nx, ny, same, block)
        for s, v in zip(SUMS, found):
            out[s][i, j] = v
        if same:
            for s, v in zip(("n", "sy", "sx", "syy", "sxx", "sxy"), found):
                out[s][j, i] = v
    return out


def matrix_of(column: pa.Array) -> np.ndarray:
    """Rows of an ``array<double>`` column as a matrix; missing cells become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    return flat.reshape(len(column), -1)


def array_column(rows: np.ndarray) -> pa.Array:
    """The inverse of ``matrix_of``."""
    ends = np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int64)
    return pa.LargeListArray.from_arrays(ends, rows.ravel()).cast(pa.list_(pa.float64()))


def _summer(passes: list[list[tuple[int, int]]], keys: list[str], same: bool):
    def add(sums, batch: pa.RecordBatch, pairs, key) -> None:
        filled, present = {}, {}
        for a, b in pairs:
            for name in (f"x{a}", f"x{b}" if same else f"y{b}"):
                if name not in filled:
                    values = matrix_of(batch.column(name))
                    present[name] = (~np.isnan(values)).astype(float)
                    filled[name] = np.nan_to_num(values, nan=0.0)
        for a, b in pairs:
            x, m = filled[f"x{a}"], present[f"x{a}"]
            right = f"x{b}" if same else f"y{b}"
            y, k = filled[right], present[right]
            found = np.stack([m.T @ k, x.T @ k, m.T @ y, (x * x).T @ k, m.T @ (y * y), x.T @ y])
            sums[key, a, b] = sums[key, a, b] + found if (key, a, b) in sums else found

    def out(sums) -> Iterator[pa.RecordBatch]:
        for (key, a, b), found in sums.items():
            data = {k: pa.array([v], pa.string()) for k, v in zip(keys, key)}
            yield pa.RecordBatch.from_pydict(data | {
                "a": pa.array([a], pa.int32()), "b": pa.array([b], pa.int32()),
                "sums": pa.array([found.tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        here = 0
        for batch in batches:
            split = [*keys, "_pass"] if len(passes) > 1 else keys
            for key, part in _split(batch, split):
                number = key[-1] if len(passes) > 1 else 0
                if number != here:  # rows come pass by pass
                    yield from out(sums)
                    sums, here = {}, number
                add(sums, part, passes[number], key[:len(keys)])
        yield from out(sums)

    return run


def _split(batch: pa.RecordBatch, by: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The rows of each combination of values, in the order of the last column."""
    if not by or not batch.num_rows:
        if batch.num_rows:
            yield (), batch
        return
    found = pa.Table.from_batches([batch]).select(by).group_by(by).aggregate([]).to_pylist()
    for key in sorted(found, key=lambda k: (k[by[-1]] is None, k[by[-1]])):
        mask = np.ones(batch.num_rows, dtype=bool)
        for name in by:
            mask &= np.array([v == key[name] for v in batch.column(name).to_pylist()])
        yield tuple(key[name] for name in by), batch.filter(pa.array(mask))


def added(table: pa.Table) -> pa.Table:
    """One row with the sum of the arrays ``sums``, and the first of all else."""
    total = sum(np.frombuffer(v.as_buffer()) for v in table["sums"])
    first = table.slice(0, 1)
    return first.set_column(first.schema.get_field_index("sums"), "sums", pa.array([total.tobytes()], pa.binary()))


def pearson(n="n", sx="sx", sy="sy", sxx="sxx", syy="syy", sxy="sxy") -> Column:
    """r from the sums; NULL for fewer than two rows or a constant side."""
    n, sx, sy, sxx, syy, sxy = (F.col(c) for c in (n, sx, sy, sxx, syy, sxy))
    vx = sxx - F.try_divide(sx * sx, n)
    vy = syy - F.try_divide(sy * sy, n)
    # what is left of a constant column is rounding noise next to its squares
    varies = (n >= 2) & (vx > sxx * 1e-13) & (vy > syy * 1e-13)
    r = F.try_divide(sxy - F.try_divide(sx * sy, n), F.sqrt(vx) * F.sqrt(vy))
    return F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))


def squared_distance(apart: Column) -> Column:
    """Squared distance over the rows where both columns are present, from sums of centred columns whose
    centres are ``apart``."""
    return F.greatest(F.col("sxx") + F.col("syy") - 2 * F.col("sxy")
                      + 2 * apart * (F.col("sx") - F.col("sy")) + F.col("n") * apart * apart, F.lit(0.0))


def named(df: DataFrame, x_names: list[str], y_names: list[str]) -> DataFrame:
    """Replace the column numbers by names."""
    x = F.array(*[F.lit(c) for c in x_names])
    y = F.array(*[F.lit(c) for c in y_names])
    return df.withColumns({"x_id": x[F.col("i")], "y_id": y[F.col("j")]}).drop("i", "j")
