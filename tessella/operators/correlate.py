"""Correlations and distances between columns, between rows and across two matrices.

Between columns: masked cross-product sums, one pass over the rows. Between rows: pairs of row
blocks. Missing cells are left out pair by pair.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.errors import EmptyResultError
from tessella.frame import cells, col, double, id_of, join_by_id, value_columns
from tessella.functions.blocks import (block_count, pair_blocks, pair_own_blocks, prepared,
                                       vectors)
from tessella.functions.gram import (SUMS, array_column, column_means, cross_sums, matrix_of, named, pearson,
                                     squared_distance)
from tessella.functions.quantiles import average_ranks
from tessella.functions.ranges import (PARTS, RANGE_ROWS, between_ranges, by_range, concordance, cuts_of,
                                       range_codes, range_counts)
from tessella.runtime import cut_lineage

# a pair of blocks works on a handful of tables of this many rows and columns, 32 MB each; rows so
# wide that they are larger than such a table make smaller blocks
BLOCK_ROWS = 2048
# squared distance, as a share of the squared lengths, below which it is taken from differences,
# and the cells of one such step
NEAR, DIFFERENCE_CELLS = 1e-3, 2**20
PAIR_SCHEMA = "x_id string, y_id string, r double, n long"


# --- between columns --------------------------------------------------------------------------

def column_correlations(df: DataFrame, method: str = "pearson",
                        id_col: str | None = None) -> DataFrame:
    """``x_id, y_id, r, n`` for each unordered pair of value columns and each column itself."""
    id_col = id_of(df, id_col)
    return _column_pairs(df, id_col, value_columns(df, id_col), None, method)


def _column_pairs(df: DataFrame, id_col: str, x_cols: list[str], y_cols: list[str] | None,
                  method: str) -> DataFrame:
    y_names = x_cols if y_cols is None else y_cols
    if method == "pearson":
        sums = cross_sums(df, x_cols, y_cols)
        out = sums.select("i", "j", pearson().alias("r"), F.col("n").cast("long").alias("n"))
    elif method == "spearman":
        out = _spearman(df, id_col, x_cols, y_cols)
    elif method == "kendall":
        out = _kendall(df, id_col, x_cols, y_cols)
    else:
        raise ValueError("method is pearson, spearman or kendall")
    return named(out, x_cols, y_names).select("x_id", "y_id", "r", "n")


def _spearman(df: DataFrame, id_col: str, x_cols: list[str],
              y_cols: list[str] | None) -> DataFrame:
    cols = x_cols if y_cols is None else [*x_cols, *y_cols]
    gaps = df.agg(F.max(F.array_contains(
        F.array(*[col(c).isNull() for c in cols]), True)).alias("g")).first()["g"]
    if gaps:
        return _spearman_with_gaps(df, x_cols, y_cols)
    long = cells(df, id_col, cols)
    ranks = average_ranks(long, "value", ["col_id"])
    placed = long.join(ranks, ["col_id", "value"])
    wide = placed.groupBy("row_id").agg(
        *[F.max(F.when(F.col("col_id") == c, F.col("rank"))).alias(c) for c in cols])
    return cross_sums(wide, x_cols, y_cols).select(
        "i", "j", pearson().alias("r"), F.col("n").cast("long").alias("n"))


def _placed(df: DataFrame, cols: list[str]) -> tuple[DataFrame, int]:
    """``row, vec`` of all rows, written once, and their number."""
    rows = cut_lineage(df.select(F.monotonically_increasing_id().alias("row"),
                                 F.array(*[double(c) for c in cols]).alias("vec")))
    return rows, rows.count()


def _wanted(p: int, q: int, same: bool) -> np.ndarray:
    """Which columns are compared, of all columns in a line: x by y, or x by x with i <= j."""
    if same:
        return np.triu(np.ones((p, p), bool))
    out = np.zeros((p + q, p + q), bool)
    out[:p, p:] = True
    return out


def _spearman_with_gaps(df: DataFrame, x_cols: list[str], y_cols: list[str] | None,
                        range_rows: int = RANGE_ROWS) -> DataFrame:
    """Ranks among the rows complete for the pair, so each pair of columns has its own ranks.

    The rank of a row in column c beside d is the number of rows with d in lower ranges of c, plus its
    rank within its range. A row's ranks come together again and only their sums leave a task.
    """
    same = y_cols is None
    cols = x_cols if same else [*x_cols, *y_cols]
    rows, n = _placed(df, cols)
    cuts = cuts_of(rows, len(cols), n, range_rows)
    pairs = _wanted(len(x_cols), 0 if same else len(y_cols), same)
    present = F.aggregate("counts", F.lit(0).cast("long"), lambda a, v: a + v)
    sizes = (range_counts(rows, cuts).groupBy("c", "range", "d").agg(F.sum(present).alias("m")))
    before = W.partitionBy("c", "d").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    lower = cut_lineage(sizes.withColumn("lower", F.coalesce(F.sum("m").over(before), F.lit(0)))
                        .groupBy("c", "range").agg(F.array_sort(F.collect_list(F.struct("d", "lower", "m"))).alias("at"))
                        .withColumn("part", F.explode(F.when(F.col("range") % 2 == 1, F.sequence(
                            F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0))))))

    def place(key: tuple, part: pa.Table, base: pa.Table) -> pa.Table:
        c, code = key[0].as_py(), key[1].as_py()
        x = matrix_of(part["vec"]) if part.num_rows else np.empty((0, len(cols)))
        out = np.full(x.shape, np.nan)
        for d, lower_rows, m in (tuple(v.values()) for v in (base["at"][0].as_py() if base.num_rows else [])):
            here = ~np.isnan(x[:, d])
            # all rows of a cut are equal; other ranges are here as a whole
            own = (m + 1) / 2 if code % 2 else pd.Series(x[here, c]).rank().to_numpy()
            out[here, d] = lower_rows + own
        return pa.table({"row": part["row"], "c": pa.array(np.full(len(x), c, np.int32)), "ranks": array_column(out)})

    ranked = by_range(rows, cuts, True).groupBy("c", "range", "part").cogroup(
        lower.groupBy("c", "range", "part")).applyInArrow(place, "row long, c int, ranks array<double>")
    whole = ranked.groupBy("row").agg(F.collect_list(F.struct("c", "ranks")).alias("r"))

    def add(batches):
        total = np.zeros((len(SUMS), len(cols), len(cols)))
        step = max(1, DIFFERENCE_CELLS // len(cols) ** 2)
        for batch in batches:
            ends, flat = batch["r"].offsets.to_numpy(), batch["r"].flatten()
            ends = ends - ends[0]
            c, ranks = flat.field("c").to_numpy(), matrix_of(flat.field("ranks"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            for a in range(0, batch.num_rows, step):
                b = min(a + step, batch.num_rows)
                x = np.full((b - a, len(cols), len(cols)), np.nan)
                here = slice(ends[a], ends[b])
                x[owner[here] - a, c[here]] = ranks[here]
                y = x.transpose(0, 2, 1)
                seen = ~(np.isnan(x) | np.isnan(y)) & pairs
                x, y = np.where(seen, x, 0.0), np.where(seen, y, 0.0)
                total += np.stack([v.sum(axis=0) for v in (seen, x, y, x * x, y * y, x * y)])
        i, j = np.nonzero(pairs & (total[0] > 0))
        yield pa.RecordBatch.from_pydict({
            "i": pa.array(i, pa.int32()), "j": pa.array(j if same else j - len(x_cols), pa.int32()),
            **{k: total[q][i, j] for q, k in enumerate(SUMS)}})

    sums = (whole.select("r").mapInArrow(add, "i int, j int, " + ", ".join(f"{k} double" for k in SUMS))
            .groupBy("i", "j").agg(*[F.sum(k).alias(k) for k in SUMS]))
    return sums.select("i", "j", pearson().alias("r"), F.col("n").cast("long").alias("n"))


def _kendall(df: DataFrame, id_col: str, x_cols: list[str], y_cols: list[str] | None,
             range_rows: int = RANGE_ROWS) -> DataFrame:
    """tau-b by counting inversions: within ranges of either column, and between ranges by their sizes."""
    same = y_cols is None
    cols = x_cols if same else [*x_cols, *y_cols]
    rows, n = _placed(df, cols)
    cuts = cuts_of(rows, len(cols), n, range_rows)
    pairs = _wanted(len(x_cols), 0 if same else len(y_cols), same)
    schema = "i int, j int, range int, s long, tied_x long, tied_y long, counts array<long>"
    kinds = [pa.int32()] * 3 + [pa.int64()] * 3 + [pa.list_(pa.int64())]

    def compare(key: tuple, part: pa.Table) -> pa.Table:
        c, code = key[0].as_py(), key[1].as_py()
        x = matrix_of(part["vec"])
        codes = range_codes(x, cuts)
        out = []
        for d in range(len(cols)):
            here = np.flatnonzero(codes[:, d] >= 0)
            if not (pairs[c, d] or pairs[d, c]) or not len(here):
                continue
            whole, tied = concordance(x[here, c], x[here, d])
            if pairs[c, d]:
                # pairs within one range of both columns are counted from either side: once too often
                twice, _ = concordance(x[here, c], x[here, d], codes[here, d])
                out.append((c, d, code, whole - twice, tied, 0,
                            np.bincount(codes[here, d], minlength=2 * len(cuts[d]) + 1)))
            if pairs[d, c]:
                out.append((d, c, code, whole, 0, tied, np.empty(0, np.int64)))
        return pa.table([pa.array(v, k) for v, k in zip(list(zip(*out)) or [[]] * 7, kinds)],
                        [f.split()[0] for f in schema.split(", ")])

    def joined(key: tuple, parts: pa.Table) -> pa.Table:
        i, j = key[0].as_py(), key[1].as_py()
        grid = np.zeros((2 * len(cuts[i]) + 1, 2 * len(cuts[j]) + 1), np.int64)
        for code, counts in zip(parts["range"].to_pylist(), parts["counts"]):
            if len(counts.values):
                grid[code] += counts.values.to_numpy()
        s, tied_x, tied_y = (int(np.sum(parts[k].to_numpy())) for k in ("s", "tied_x", "tied_y"))
        s += between_ranges(grid)
        cut_x, cut_y = grid.sum(axis=1)[1::2], grid.sum(axis=0)[1::2]  # all pairs of a cut are tied
        tied_x += int((cut_x * (cut_x - 1) // 2).sum())
        tied_y += int((cut_y * (cut_y - 1) // 2).sum())
        m = int(grid.sum())
        every = m * (m - 1) // 2
        spread = math.sqrt(every - tied_x) * math.sqrt(every - tied_y)
        return pa.table({"i": pa.array([i], pa.int32()), "j": pa.array([j if same else j - len(x_cols)], pa.int32()),
                         "r": pa.array([s / spread if spread else None], pa.float64()), "n": pa.array([m], pa.int64())})

    inside = by_range(rows, cuts, False).groupBy("c", "range").applyInArrow(compare, schema)
    parts = inside
    if any(len(own) for own in cuts):
        zero = F.lit(0).cast("long")
        on_cuts = range_counts(rows, cuts, odd_only=True).select(
            F.col("c").alias("i"), F.col("d").alias("j"), "range", zero.alias("s"), zero.alias("tied_x"),
            zero.alias("tied_y"), "counts")
        wanted = F.array(*[F.array(*[F.lit(bool(v)) for v in row]) for row in pairs])
        parts = inside.unionByName(on_cuts.where(wanted[F.col("i")][F.col("j")]))
    return parts.groupBy("i", "j").applyInArrow(joined, "i int, j int, r double, n long").where("n > 0")


def column_distances(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Euclidean distances ``x_id, y_id, distance, n`` between two different value columns.

    With missing cells the squared distance over the present ones is scaled up to all rows. Pairs of
    columns that lie very close, which one job looks for, take a second pass over the rows.
    """
    cols = value_columns(df, id_col)
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    # sums of centred columns don't cancel; the means come back as a difference per pair
    sums = cross_sums(df, cols).where("i < j").withColumn("_m", column_means(df, cols))
    apart = F.col("_m")[F.col("i")] - F.col("_m")[F.col("j")]
    found = cut_lineage(sums.select("i", "j", "n", squared_distance(apart).alias("d2"),
                                    (F.col("sxx") + F.col("syy") + F.col("n") * apart * apart).alias("_whole")))
    # columns that lie close for their length lose digits in the sums: take their differences
    near = found.where((F.col("d2") < NEAR * F.col("_whole")) & (F.col("n") > 0)).select("i", "j").toArrow()
    if near.num_rows:
        close = _column_differences(df, cols, near["i"].to_numpy(), near["j"].to_numpy())
        found = (found.join(close.withColumnRenamed("d2", "_exact"), ["i", "j"], "left")
                 .withColumn("d2", F.coalesce("_exact", "d2")))
    out = found.select("i", "j", F.sqrt(F.col("d2") * F.try_divide(rows, F.col("n"))).alias("distance"),
                       F.col("n").cast("long").alias("n"))
    return named(out, cols, cols).select("x_id", "y_id", "distance", "n")


def _column_differences(df: DataFrame, cols: list[str], i: np.ndarray, j: np.ndarray) -> DataFrame:
    """``i, j, d2``: squared distances of some pairs of columns from the differences of their cells."""
    def add(batches):
        total = np.zeros(len(i))
        for batch in batches:
            x = matrix_of(batch["vec"])
            step = max(1, DIFFERENCE_CELLS // max(1, len(x)))
            for a in range(0, len(i), step):
                total[a:a + step] += np.nansum((x[:, i[a:a + step]] - x[:, j[a:a + step]]) ** 2, axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "d2": total})

    rows = df.select(F.array(*[double(c) for c in cols]).alias("vec"))
    return rows.mapInArrow(add, "i int, j int, d2 double").groupBy("i", "j").agg(F.sum("d2").alias("d2"))


# --- between rows -----------------------------------------------------------------------------

def _ranked(x: np.ndarray) -> np.ndarray:
    return pd.DataFrame(x).rank(axis=1).to_numpy()


def block_pearson(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """r and n of each row of x with each row of y, over the columns both have."""
    mx, my = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
    x = np.nan_to_num(x - _row_mean(x, mx))
    y = np.nan_to_num(y - _row_mean(y, my))
    n = mx @ my.T
    sx, sy = x @ my.T, mx @ y.T
    sxx, syy, sxy = (x * x) @ my.T, mx @ (y * y).T, x @ y.T
    with np.errstate(divide="ignore", invalid="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        r = (sxy - sx * sy / n) / (np.sqrt(vx) * np.sqrt(vy))
        r[~((n >= 2) & (vx > sxx * 1e-13) & (vy > syy * 1e-13))] = np.nan
    return np.clip(r, -1.0, 1.0), n


def _row_mean(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    return (np.nan_to_num(x).sum(1) / np.maximum(present.sum(1), 1))[:, None]


def block_correlation(x: np.ndarray, y: np.ndarray, method: str):
    if method == "pearson":
        return block_pearson(x, y)
    if method != "spearman":
        raise ValueError("method between rows is pearson or spearman")
    if not (np.isnan(x).any() or np.isnan(y).any()):
        return block_pearson(_ranked(x), _ranked(y))
    r, n = np.empty((len(x), len(y))), np.empty((len(x), len(y)))
    for i, row in enumerate(x):
        gap = np.isnan(row)[None, :] | np.isnan(y)
        a = _ranked(np.where(gap, np.nan, row[None, :]))
        b = _ranked(np.where(gap, np.nan, y))
        r[i], n[i] = _row_by_row(a, b)
    return r, n


def _row_by_row(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """r and n of each row of x with the same row of y; both miss the same cells."""
    n = (~np.isnan(x)).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        x, y = (np.nan_to_num(v - (np.nansum(v, axis=1) / n)[:, None]) for v in (x, y))
        xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
        r = (x * y).sum(axis=1) / (np.sqrt(xx) * np.sqrt(yy))
        r[~((n >= 2) & (xx > 0) & (yy > 0))] = np.nan
    return np.clip(r, -1.0, 1.0), n


def _ids(table: pa.Table) -> np.ndarray:
    return table["id"].to_numpy()


def _cells_table(left, right, keep, **values) -> pa.Table:
    i, j = np.nonzero(keep)
    out = {"x_id": _ids(left)[i], "y_id": _ids(right)[j]}
    for name, v in values.items():
        out[name] = pa.array(v[i, j], from_pandas=True)
    out["n"] = out["n"].cast(pa.int64())
    return pa.table(out)


def _own_pairs(df, id_col, cell_values, schema, block_rows, diagonal) -> DataFrame:
    rows, n = prepared(vectors(df, id_col))
    blocks = block_count(n, len(value_columns(df, id_col)), block_rows, BLOCK_ROWS)
    before = np.less_equal if diagonal else np.less

    def meet(left, right, same):
        values = cell_values(matrix_of(left["vec"]), matrix_of(right["vec"]))
        shape = values["n"].shape
        # a pair is listed once, smaller id first
        keep = before.outer(_ids(left), _ids(right)) if same else np.ones(shape, bool)
        return _cells_table(left, right, keep, **values)

    found = pair_own_blocks(rows, blocks, meet, schema)
    swap = F.col("x_id") > F.col("y_id")
    return found.withColumns({"x_id": F.when(swap, F.col("y_id")).otherwise(F.col("x_id")),
                              "y_id": F.when(swap, F.col("x_id")).otherwise(F.col("y_id"))})


def row_correlations(df: DataFrame, method: str = "pearson", id_col: str | None = None,
                     block_rows: int | None = None) -> DataFrame:
    """``x_id, y_id, r, n`` for each unordered pair of rows and each row itself.

    The result is the correlation matrix of the rows, so its size is the square of their number.
    """
    def values(x, y):
        r, n = block_correlation(x, y, method)
        return {"r": r, "n": n}

    return _own_pairs(df, id_col, values, PAIR_SCHEMA, block_rows, diagonal=True)


def block_euclidean(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances over the present cells, scaled up to all columns, and the number of cells."""
    mx, my = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
    # distances don't change when both sides move, so large offsets of a column are taken off
    origin = np.nan_to_num(x).sum(axis=0) / np.maximum(mx.sum(axis=0), 1)
    x, y = np.nan_to_num(x - origin), np.nan_to_num(y - origin)
    n = mx @ my.T
    whole = (x * x) @ my.T + mx @ (y * y).T
    d2 = np.maximum(whole - 2 * (x @ y.T), 0.0)
    # rows that lie close for their length lose digits in the product: take their differences
    near = np.argwhere((d2 < NEAR * whole) & (n > 0))
    step = max(1, DIFFERENCE_CELLS // max(1, x.shape[1]))
    for start in range(0, len(near), step):
        i, j = near[start:start + step].T
        d2[i, j] = ((x[i] - y[j]) ** 2 * mx[i] * my[j]).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, np.sqrt(d2 * (x.shape[1] / n)), np.nan), n


def row_distances(df: DataFrame, id_col: str | None = None,
                  block_rows: int | None = None) -> DataFrame:
    """Euclidean distances ``x_id, y_id, distance, n`` between two different rows."""
    def values(x, y):
        d, n = block_euclidean(x, y)
        return {"distance": d, "n": n}

    return _own_pairs(df, id_col, values, "x_id string, y_id string, distance double, n long",
                      block_rows, diagonal=False)


# --- across two matrices ----------------------------------------------------------------------

def integrate_cross_cor(x: DataFrame, y: DataFrame, axis: int = 0, method: str = "pearson",
                        check: bool = False, block_rows: int | None = None) -> DataFrame:
    """Correlate the columns (axis 0) or the rows (axis 1) of two matrices.

    Only shared row ids (axis 0) or columns (axis 1) count. Long result ``x_id, y_id, r, n``;
    ``cross_cor_wide`` gives the matrix. With ``check`` a job compares the row ids for axis 0:
    none in common is an error, some a warning. Transpose y first where it is turned.
    """
    x_cols, y_cols = value_columns(x), value_columns(y)
    if axis == 1:
        shared = sorted(set(x_cols) & set(y_cols))
        _report_shared(len(shared), max(len(x_cols), len(y_cols)))
        (left, n_left), (right, n_right) = (prepared(vectors(m, None, shared)) for m in (x, y))
        sizes = [block_count(n, len(shared), block_rows, BLOCK_ROWS) for n in (n_left, n_right)]

        def meet(a, b):
            r, n = block_correlation(matrix_of(a["vec"]), matrix_of(b["vec"]), method)
            return _cells_table(a, b, np.ones(r.shape, bool), r=r, n=n)

        return pair_blocks(left, right, *sizes, meet, PAIR_SCHEMA)
    a = x.select(col(id_of(x)).cast("string").alias("_id"),
                 *[double(c).alias(f"x:{c}") for c in x_cols])
    b = y.select(col(id_of(y)).cast("string").alias("_id"),
                 *[double(c).alias(f"y:{c}") for c in y_cols])
    if check:
        n = (a.select("_id", F.lit(1).alias("a")).join(b.select("_id", F.lit(1).alias("b")),
                                                       "_id", "full")
             .agg(F.count("a").alias("a"), F.count("b").alias("b"),
                  F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"))
             .first())
        _report_shared(n["both"], max(n["a"], n["b"]))
    joined = a.join(b, "_id")
    out = _column_pairs(joined, "_id", [f"x:{c}" for c in x_cols], [f"y:{c}" for c in y_cols],
                        method)
    return out.withColumns({c: F.substring(c, 3, 2**31 - 1) for c in ("x_id", "y_id")})


def _report_shared(shared: int, longest: int) -> None:
    if shared == 0:
        raise EmptyResultError("no shared ids to correlate over")
    if shared < longest:
        warnings.warn(f"ids differ: correlating over {shared} of {longest}", stacklevel=3)


def cross_cor_wide(pairs: DataFrame, axis: int = 0, names: list[str] | None = None) -> DataFrame:
    """Matrix form: axis 0 has a row per y column, axis 1 a row per x row."""
    rows, columns = ("y_id", "x_id") if axis == 0 else ("x_id", "y_id")
    if names is None:
        names = [r[0] for r in pairs.select(columns).distinct().orderBy(columns).collect()]
    return pairs.groupBy(rows).pivot(columns, names).agg(F.first("r"))


# --- summaries --------------------------------------------------------------------------------

def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair in both directions, the diagonal once."""
    turned = pairs.where("x_id <> y_id").select(
        F.col("y_id").alias("x_id"), F.col("x_id").alias("y_id"),
        *[c for c in pairs.columns if c not in ("x_id", "y_id")])
    return pairs.select(*turned.columns).unionByName(turned)


def median_correlations(pairs: DataFrame) -> DataFrame:
    """``id, median_cor``: the median of a column's or row's correlations, itself included."""
    return both_ways(pairs).groupBy(F.col("x_id").alias("id")).agg(
        F.percentile("r", F.lit(0.5)).alias("median_cor"))


# bins of the first look at a row's correlations
MEDIAN_BINS = 512


def row_median_correlations(df: DataFrame, method: str = "pearson", id_col: str | None = None,
                            block_rows: int | None = None) -> DataFrame:
    """``id, median_cor``: the median of each row's correlations with all rows, itself included.

    No pair is listed. Pairs of blocks count each row's correlations in bins, the counts add up to the
    bin that holds the middle, and a second look at the blocks returns what lies in that bin only. Exact;
    a row without any correlation has none.
    """
    rows, n = prepared(vectors(df, id_col))
    blocks = block_count(n, len(value_columns(df, id_col)), block_rows, BLOCK_ROWS)

    def sides(left, right, same):
        r, _ = block_correlation(matrix_of(left["vec"]), matrix_of(right["vec"]), method)
        return [(left, r)] if same else [(left, r), (right, r.T)]

    def bins(r):
        return np.clip(np.floor((r + 1) / 2 * MEDIAN_BINS), 0, MEDIAN_BINS - 1)

    def count(left, right, same):
        out = []
        for own, r in sides(left, right, same):
            place = np.where(np.isnan(r), MEDIAN_BINS, bins(r)).astype(np.int64)
            place += np.arange(len(r))[:, None] * (MEDIAN_BINS + 1)
            found = np.bincount(place.ravel(), minlength=len(r) * (MEDIAN_BINS + 1))
            found = found.reshape(len(r), -1)[:, :MEDIAN_BINS].astype(float)
            out.append(pa.table({"id": own["id"], "counts": array_column(found)}))
        return pa.concat_tables(out)

    def middle(counts: pa.Table) -> pa.Table:
        total = matrix_of(counts["counts"]).sum(axis=0)
        upto, m = np.cumsum(total), total.sum()
        # bins of the two middle ranks, and how many lie below the first
        low, high = (int(np.searchsorted(upto, rank, side="right")) for rank in ((m - 1) // 2, m // 2))
        return pa.table({"id": counts["id"].slice(0, 1), "low": pa.array([low if m else -1], pa.int32()),
                         "high": pa.array([high if m else -1], pa.int32()),
                         "m": pa.array([int(m)], pa.int64()),
                         "below": pa.array([int(upto[low] - total[low]) if m else 0], pa.int64())})

    counted = pair_own_blocks(rows, blocks, count, "id string, counts array<double>")
    # a pair of blocks sends one array per row; arrays of a row are added in two steps
    part = F.pmod(F.spark_partition_id(), F.lit(16)).alias("_part")
    added = counted.groupBy("id", part).applyInArrow(
        lambda t: pa.table({"id": t["id"].slice(0, 1), "counts": array_column(
            matrix_of(t["counts"]).sum(axis=0, keepdims=True))}), "id string, counts array<double>")
    bracket = cut_lineage(added.groupBy("id").applyInArrow(
        middle, "id string, low int, high int, m long, below long"))
    bracketed = cut_lineage(rows.join(bracket, "id"))

    def inside(left, right, same):
        out = []
        for own, r in sides(left, right, same):
            place = bins(r)
            low, high = (own[k].to_numpy()[:, None] for k in ("low", "high"))
            # between the two bins there is nothing
            i, j = np.nonzero((place == low) | (place == high))
            out.append(pa.table({"id": own["id"].take(pa.array(i)), "r": r[i, j]}))
        return pa.concat_tables(out)

    held = (pair_own_blocks(bracketed, blocks, inside, "id string, r double")
            .groupBy("id", "r").agg(F.count(F.lit(1)).alias("c")))
    upto = F.sum("c").over(W.partitionBy("id").orderBy("r").rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = held.join(bracket, "id").withColumn("upto", F.col("below") + upto)

    def value_at(rank):
        return F.min(F.when(F.col("upto") > rank, F.col("r")))

    return ranked.groupBy("id").agg(
        ((value_at(F.floor((F.col("m") - 1) / 2)) + value_at(F.floor(F.col("m") / 2))) / 2).alias("median_cor")
    ).join(bracket.select("id"), "id", "right").select("id", "median_cor")


def has_negative_median(df: DataFrame, id_col: str | None = None,
                        block_rows: int | None = None) -> bool:
    """Whether the median correlation of some row with all rows, itself included, is negative.

    A median is negative when most values are, or when the two middle ones add up to less than
    zero. Both follow from four numbers per row that add up over blocks, so no pair is listed.
    """
    rows, n = prepared(vectors(df, id_col))
    blocks = block_count(n, len(value_columns(df, id_col)),
                         block_rows, BLOCK_ROWS)

    def meet(left, right, same):
        r, _ = block_pearson(matrix_of(left["vec"]), matrix_of(right["vec"]))
        sides = [(left, r)] if same else [(left, r), (right, r.T)]
        parts = []
        for table, own in sides:
            below = own < 0
            parts.append((_ids(table), (~np.isnan(own)).sum(1), below.sum(1),
                          np.where(below, own, -np.inf).max(1),
                          np.where(own >= 0, own, np.inf).min(1)))
        names = ("id", "n", "below", "under", "over")
        return pa.table({k: np.concatenate(v) for k, v in zip(names, zip(*parts))})

    found = pair_own_blocks(rows, blocks, meet,
                            "id string, n long, below long, under double, over double")
    per_row = found.groupBy("id").agg(F.sum("n").alias("n"), F.sum("below").alias("below"),
                                      F.max("under").alias("under"), F.min("over").alias("over"))
    twice = F.col("below") * 2
    return not per_row.where((twice > F.col("n")) | (
        (twice == F.col("n")) & (F.col("under") + F.col("over") < 0))).isEmpty()


def correlation_summary(medians: DataFrame) -> DataFrame:
    return medians.agg(F.avg("median_cor").alias("mean"),
                       F.percentile("median_cor", F.lit(0.5)).alias("median"))


def top_correlated(medians: DataFrame, which: str = "highest", k: int = 10) -> DataFrame:
    """The k highest, most negative or closest to zero median correlations."""
    order: dict[str, Column] = {
        "highest": F.col("median_cor").desc_nulls_last(),
        "lowest": F.col("median_cor").asc_nulls_last(),
        "closest_to_zero": F.abs("median_cor").asc_nulls_last(),
    }
    return medians.orderBy(order[which], "id").limit(k)


# --- removing correlated rows -----------------------------------------------------------------

MEAN_DIGITS = 12


def mean_absolute_correlations(rows: DataFrame, blocks: int, method: str) -> DataFrame:
    """``id, mean_r`` over all other rows; a pair of blocks emits one sum per row."""
    def meet(left, right, same):
        r, _ = block_correlation(matrix_of(left["vec"]), matrix_of(right["vec"]), method)
        r = np.abs(r)
        if same:
            np.fill_diagonal(r, np.nan)
        seen = ~np.isnan(r)
        r = np.nan_to_num(r)
        ids, total, n = [_ids(left)], [r.sum(1)], [seen.sum(1)]
        if not same:
            ids, total, n = [*ids, _ids(right)], [*total, r.sum(0)], [*n, seen.sum(0)]
        return pa.table({"id": np.concatenate(ids), "total": np.concatenate(total),
                         "n": np.concatenate(n)})

    parts = pair_own_blocks(rows, blocks, meet, "id string, total double, n long")
    return parts.groupBy("id").agg(F.round(F.try_divide(F.sum("total"), F.sum("n")), MEAN_DIGITS)
                                   .alias("mean_r"))


def correlated_rows(df: DataFrame, cutoff: float = 0.9, method: str = "pearson",
                    id_col: str | None = None, block_rows: int | None = None) -> DataFrame:
    """Ids to remove: of two rows with ``abs(r) > cutoff`` the one with the larger mean ``abs(r)``.

    On a tie the smaller id goes. A pair of blocks emits the ids it removes, never the pairs, so a
    large group of copies costs no more than other rows.
    """
    rows, n = prepared(vectors(df, id_col))
    blocks = block_count(n, len(value_columns(df, id_col)), block_rows, BLOCK_ROWS)
    weighted = rows.join(mean_absolute_correlations(rows, blocks, method), "id")

    def meet(left, right, same):
        r, _ = block_correlation(matrix_of(left["vec"]), matrix_of(right["vec"]), method)
        ids_l, ids_r = _ids(left), _ids(right)
        mean_l = left["mean_r"].to_numpy().astype(float)[:, None]
        mean_r = right["mean_r"].to_numpy().astype(float)[None, :]
        hit = np.abs(np.nan_to_num(r)) > cutoff
        if same:
            np.fill_diagonal(hit, False)
        first = (mean_l > mean_r) | ((mean_l == mean_r) & (ids_l[:, None] < ids_r[None, :]))
        gone = [ids_l[(hit & first).any(1)], ids_r[(hit & ~first).any(0)]]
        return pa.table({"id": pa.array(np.unique(np.concatenate(gone).astype(object)),
                                        pa.string())})

    return pair_own_blocks(weighted, blocks, meet, "id string").distinct()


def filter_rows_max_correlation(df: DataFrame, cutoff: float = 0.9, method: str = "pearson",
                                id_col: str | None = None,
                                block_rows: int | None = None) -> DataFrame:
    """Remove rows until no two that are left correlate beyond the cutoff."""
    id_col = id_of(df, id_col)
    gone = correlated_rows(df, cutoff, method, id_col, block_rows)
    return join_by_id(df, gone, id_col, "left_anti")
