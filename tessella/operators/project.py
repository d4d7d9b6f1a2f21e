"""Principal components of a matrix, with rows or columns as observations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col, double, id_of, value_columns
from tessella.functions.aggregates import NORMAL_MAD_SCALE
from tessella.functions.gram import added, array_column, gram_arrays, matrix_of
from tessella.functions.quantiles import quantiles

NOT_FINITE = "unable to perform PCA: missing or infinite values encountered"


def _finite(cells: Column) -> Column:
    """The cells, or an error while the data is read."""
    bad = F.exists(cells, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(bad, F.raise_error(F.lit(NOT_FINITE)).cast("array<double>")).otherwise(cells)


def _cells(df: DataFrame, cols: list[str]) -> Column:
    return F.array(*[double(c) for c in cols])


def _signs(loadings: np.ndarray) -> np.ndarray:
    """Sign that makes the largest loading of each component positive."""
    top = np.abs(loadings).argmax(axis=0)
    return np.where(loadings[top, np.arange(loadings.shape[1])] < 0, -1.0, 1.0)


def _eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    vectors = vectors[:, order]
    return np.maximum(values[order], 0.0), vectors * _signs(vectors)


class ColumnPCA:
    """PCA with rows as observations. Only the p×p loadings come to the driver."""

    def __init__(self, df: DataFrame, num_dims: int, scale: bool, id_col: str | None) -> None:
        self.id_col = id_of(df, id_col)
        self.cols = value_columns(df, self.id_col)
        self.dims = min(num_dims, len(self.cols))
        data = df.select(col(self.id_col), array_to_vector(
            _finite(_cells(df, self.cols))).alias("_x"))
        scaler = StandardScaler(withMean=True, withStd=scale, inputCol="_x", outputCol="_s")
        self.fitted = scaler.fit(data)
        self.data = self.fitted.transform(data)
        self.model = PCA(k=self.dims, inputCol="_s", outputCol="_pc").fit(self.data)
        sd = np.asarray(self.fitted.std.toArray())
        self.total_variance = float((sd > 0).sum() if scale else (sd ** 2).sum())

    @property
    def variances(self) -> np.ndarray:
        return np.asarray(self.model.explainedVariance.toArray()) * self.total_variance

    def scores(self, whiten: bool) -> DataFrame:
        factor = _signs(np.asarray(self.model.pc.toArray()))
        if whiten:
            with np.errstate(divide="ignore"):
                factor = np.where(self.variances > 0, factor / np.sqrt(self.variances), 0.0)
        pc = self.model.transform(self.data).select(
            col(self.id_col), vector_to_array("_pc").alias("_pc"))
        return pc.select(col(self.id_col), *[
            (F.col("_pc")[i] * float(factor[i])).alias(f"PC{i + 1}") for i in range(self.dims)])


class RandomPCA:
    """PCA of wide matrices by a randomised range finder with power steps (Halko et al. 2011).

    A few random directions are sent through X'X several times: each time every task adds up its part of
    X'(X q), columns by directions, and the sums are added in a tree. What the driver sees is as wide as
    the columns and as long as ``num_dims + extra``, never columns by columns. Every step reads the rows
    once. With as many directions as columns the result is exact; else the leading components are close.
    """

    def __init__(self, df: DataFrame, num_dims: int, scale: bool, id_col: str | None, steps: int = 6,
                 extra: int = 10, seed: int = 1) -> None:
        self.id_col = id_of(df, id_col)
        self.cols = value_columns(df, self.id_col)
        p = len(self.cols)
        self.dims = min(num_dims, p)
        self.data = df.select(col(self.id_col), _finite(_cells(df, self.cols)).alias("_x"))
        at = [F.col("_x")[i] for i in range(p)]
        found = self.data.agg(F.count(F.lit(1)), *[F.avg(c) for c in at], *[F.stddev_samp(c) for c in at]).first()
        self.rows = found[0]
        self.mean = np.array([v or 0.0 for v in found[1:p + 1]])
        sd = np.array([v or 0.0 for v in found[p + 1:]])
        self.sd = np.where(sd > 0, sd, 1.0) if scale else np.ones(p)
        self.total_variance = float((sd > 0).sum() if scale else (sd ** 2).sum())
        wide = min(p, self.dims + extra)
        q = np.linalg.qr(np.random.default_rng(seed).normal(size=(p, wide)))[0]
        for _ in range(steps):
            q = np.linalg.qr(self._through(q))[0]
        inner = q.T @ self._through(q)
        self.values, vectors = _eigen((inner + inner.T) / 2, self.dims)
        loadings = q @ vectors
        self.loadings = loadings * _signs(loadings)

    def _through(self, q: np.ndarray) -> np.ndarray:
        """X'X q of the centred and scaled rows."""
        mean, sd = self.mean, self.sd

        def add(batches):
            total = np.zeros(q.shape)
            for batch in batches:
                x = (matrix_of(batch.column("_x")) - mean) / sd
                total += x.T @ (x @ q)
            yield pa.RecordBatch.from_pydict({"sums": pa.array([total.tobytes()], pa.binary())})

        parts = self.data.select("_x").mapInArrow(add, "sums binary").withColumn("_task", F.spark_partition_id())
        for fan in (16, 256):
            parts = parts.groupBy(F.floor(F.col("_task") / fan).alias("_up")).applyInArrow(
                added, "sums binary, _task int")
        return sum((np.frombuffer(r["sums"]).reshape(q.shape) for r in parts.toLocalIterator()), np.zeros(q.shape))

    @property
    def variances(self) -> np.ndarray:
        return self.values / max(1, self.rows - 1)

    def scores(self, whiten: bool) -> DataFrame:
        mean, sd, loadings = self.mean, self.sd, self.loadings
        if whiten:
            with np.errstate(divide="ignore"):
                loadings = loadings * np.where(self.variances > 0, 1 / np.sqrt(self.variances), 0.0)

        @F.arrow_udf("array<double>")
        def project(x: pa.Array) -> pa.Array:
            return array_column(((matrix_of(x) - mean) / sd) @ loadings)

        return (self.data.select(col(self.id_col), project("_x").alias("_pc"))
                .select(col(self.id_col), *[F.col("_pc")[i].alias(f"PC{i + 1}") for i in range(self.dims)]))


def _column_fit(df: DataFrame, num_dims: int, scale: bool, id_col: str | None, method: str):
    if method not in ("exact", "random"):
        raise ValueError("method is exact or random")
    return (ColumnPCA if method == "exact" else RandomPCA)(df, num_dims, scale, id_col)


def _row_centred(df: DataFrame, id_col: str, cols: list[str], scale: bool) -> DataFrame:
    """Each row minus its mean, over its sample sd when scaled; constant rows become zero."""
    p = float(len(cols))

    def centre(x):
        return F.transform(F.array(F.aggregate(x, F.lit(0.0), lambda a, b: a + b) / p),
                           lambda m: F.transform(x, lambda v: v - m))[0]

    def unit(x):
        squares = F.aggregate(x, F.lit(0.0), lambda a, b: a + b * b)
        return F.transform(F.array(F.sqrt(squares / (p - 1))), lambda sd: F.transform(
            x, lambda v: F.coalesce(F.try_divide(v, sd), F.lit(0.0))))[0]

    out = df.select(centre(_finite(_cells(df, cols))).alias("_x"))
    if scale:
        out = out.select(unit(F.col("_x")).alias("_x"))
    return out.select(*[F.col("_x")[i].alias(c) for i, c in enumerate(cols)])


def _row_eigen(df: DataFrame, num_dims: int, scale: bool, id_col: str | None):
    """Columns as observations, rows as features: the p×p inner products of the centred rows.

    The rows, of which there may be any number, never become columns.
    """
    id_col = id_of(df, id_col)
    cols = value_columns(df, id_col)
    inner = gram_arrays(_row_centred(df, id_col, cols, scale), cols, shift=False)["sxy"]
    values, vectors = np.linalg.eigh(inner)
    order = np.argsort(values)[::-1][:min(num_dims, len(cols))]
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    # the loadings live on the rows; a component's sign follows its largest score instead
    return id_col, cols, values, vectors * _signs(vectors), float(np.trace(inner))


def project_pca(df: DataFrame, target: str = "columns", num_dims: int = 10,
                whiten: bool = False, scale: bool = False,
                id_col: str | None = None, method: str = "exact") -> DataFrame:
    """Project onto the first principal components, centred and by default unscaled.

    ``target='columns'`` replaces the columns by ``PC1…`` for each row; ``'rows'`` replaces the
    rows by ``PC1…`` for each column. Missing or infinite cells are an error. Of the two possible
    signs the one that makes the largest loading (rows: score) positive is taken. With the method
    ``random``, for columns in the thousands, no matrix of columns by columns is formed.
    """
    if target == "columns":
        return _column_fit(df, num_dims, scale, id_col, method).scores(whiten)
    if target != "rows":
        raise ValueError("target is columns or rows")
    id_col, cols, values, vectors, _ = _row_eigen(df, num_dims, scale, id_col)
    scores = vectors * (np.sqrt(len(cols) - 1) if whiten else np.sqrt(values))
    rows = [(f"PC{i + 1}", *map(float, scores[:, i])) for i in range(scores.shape[1])]
    ddl = ", ".join(f"`{c}` double" for c in cols)
    return df.sparkSession.createDataFrame(rows, f"`{id_col}` string, {ddl}")


def pca_variance(df: DataFrame, target: str = "columns", num_dims: int = 10, scale: bool = True,
                 id_col: str | None = None, method: str = "exact") -> DataFrame:
    """``component, variance, percent, cumulative`` of the leading components."""
    if target == "columns":
        fit = _column_fit(df, num_dims, scale, id_col, method)
        variances, total = fit.variances, fit.total_variance
    else:
        _, cols, values, _, trace = _row_eigen(df, num_dims, scale, id_col)
        variances, total = values / (len(cols) - 1), trace / (len(cols) - 1)
    percent = 100 * variances / total if total else np.zeros_like(variances)
    rows = [(f"PC{i + 1}", float(variances[i]), float(percent[i]), float(percent[:i + 1].sum()))
            for i in range(len(variances))]
    return df.sparkSession.createDataFrame(
        rows, "component string, variance double, percent double, cumulative double")


def robust_pca(df: DataFrame, num_dims: int = 2, id_col: str | None = None) -> DataFrame:
    """Spatial-sign PCA: directions only, so that far rows pull no more than near ones.

    Columns are centred by the median and scaled by the MAD, each row is brought to length one, and
    the components of those directions project the scaled rows. (Locantore et al. 1999; not the
    grid search, whose values differ.)
    """
    id_col = id_of(df, id_col)
    cols = value_columns(df, id_col)
    data = df.select(col(id_col), _finite(_cells(df, cols)).alias("_x"))
    wide = data.select(*[F.col("_x")[i].alias(c) for i, c in enumerate(cols)])
    centre = _medians(wide, cols)
    deviation = _medians(wide.select(*[
        F.abs(col(c) - F.lit(centre[i])).alias(c) for i, c in enumerate(cols)]), cols)
    scale = [d / NORMAL_MAD_SCALE if d else 1.0 for d in deviation]
    scaled = data.select(col(id_col), F.array(*[
        (F.col("_x")[i] - F.lit(centre[i])) / F.lit(scale[i]) for i in range(len(cols))])
        .alias("_z"))
    length = F.sqrt(F.aggregate("_z", F.lit(0.0), lambda a, z: a + z * z))
    signs = (scaled.withColumn("_len", length)
             .select(*[F.coalesce(F.try_divide(F.col("_z")[i], F.col("_len")), F.lit(0.0)).alias(c)
                       for i, c in enumerate(cols)]))
    sums = gram_arrays(signs, cols, shift=False)
    spread = sums["sxy"] / np.maximum(sums["n"], 1)
    _, loadings = _eigen(spread, min(num_dims, len(cols)))
    scores = [F.aggregate(F.zip_with("_z", F.lit([float(w) for w in loadings[:, k]]),
                                     lambda z, w: z * w), F.lit(0.0), lambda a, b: a + b)
              .alias(f"PC{k + 1}") for k in range(loadings.shape[1])]
    return scaled.select(col(id_col), *scores)


def _medians(df: DataFrame, cols: list[str]) -> list[float]:
    long = df.unpivot([], [col(c) for c in cols], "_col", "_v")
    found = {r["_col"]: r["q"][0] for r in quantiles(
        long, "_v", [0.5], ["_col"]).collect()}
    return [found[c] for c in cols]
