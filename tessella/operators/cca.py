"""Sparse canonical correlation of two matrices, with permutation p-values.

All that the method needs of the rows are cross products: X'Y, X'X, Y'Y and X'Y for each reshuffle
of the rows. Those are summed in one distributed pass; the penalised vectors are then found from
p×q numbers, one task per reshuffle. (Witten, Tibshirani and Hastie 2009.)
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col, double, id_of, value_columns
from tessella.functions.gram import cross_sums, gram_arrays
from tessella.functions.quantiles import average_ranks
from tessella.runtime import cut_lineage

# sums of absolute loadings, as shares of the largest possible (fixed values: 0.1 to 0.7 in ten steps)
PENALTIES = tuple(np.linspace(0.1, 0.7, 10))
# keeps the z statistic finite for reshuffles that hardly differ (fixed value)
SD_FLOOR = 0.05


def _row_pairs(x: DataFrame, y: DataFrame, permutations: int,
               seed: int) -> tuple[DataFrame, DataFrame]:
    """``perm, x columns, y columns`` for reshuffles 1, 2, …, and the rows as they belong.

    Rows get a number in the order of a seeded hash; a reshuffle maps number r to (a·r + b) mod n
    with a prime to n, so every row has exactly one partner and no list of rows is ever gathered.
    """
    key = F.struct(F.xxhash64("_id", F.lit(seed)).alias("h"), F.col("_id").alias("id"))
    both = x.join(y, "_id")
    order = average_ranks(both.select(key.alias("_k")), "_k").select(
        F.col("_k.id").alias("_id"), (F.col("rank") - 1).cast("long").alias("_r"))
    # written once: every reshuffle and both sides read it again
    placed = cut_lineage(both.join(order, "_id"))
    n = placed.count()
    draw = random.Random(seed)
    steps = []
    for k in range(1, permutations + 1):
        a, b = 1, 0
        while n > 1 and (math.gcd(a, n) != 1 or (a, b) == (1, 0)):  # never the rows as they are
            a, b = draw.randrange(1, n), draw.randrange(n)
        steps.append((k, a, b))
    maps = F.array(*[F.struct(F.lit(k).alias("perm"), F.lit(a).cast("long").alias("a"),
                              F.lit(b).cast("long").alias("b")) for k, a, b in steps])
    xs = placed.select("_r", *[col(c) for c in x.columns if c != "_id"], F.explode(maps).alias("m"))
    xs = xs.select("m.perm", ((F.col("_r").cast("decimal(19,0)") * F.col("m.a") + F.col("m.b")) % n)
                   .cast("long").alias("_r"),
                   *[col(c) for c in x.columns if c != "_id"])
    ys = placed.select("_r", *[col(c) for c in y.columns if c != "_id"])
    return xs.join(ys, "_r").drop("_r"), placed


def _centred_square(sums: dict[str, np.ndarray]) -> np.ndarray:
    return sums["sxy"] - sums["sx"] * sums["sy"] / sums["n"]


def shrink_to(values: np.ndarray, bound: float) -> np.ndarray:
    """Soft-threshold to unit length with at most ``bound`` as sum of absolute values."""
    size = np.linalg.norm(values)
    if size == 0 or np.abs(values).sum() / size <= bound:
        return values / size if size else values
    low, high = 0.0, np.abs(values).max() * (1 - 1e-7)
    for _ in range(150):
        middle = (low + high) / 2
        cut = np.sign(values) * np.maximum(np.abs(values) - middle, 0)
        if np.abs(cut).sum() / np.linalg.norm(cut) < bound:
            high = middle
        else:
            low = middle
        if high - low < 1e-9 * np.abs(values).max():
            break
    cut = np.sign(values) * np.maximum(np.abs(values) - (low + high) / 2, 0)
    return cut / np.linalg.norm(cut)


def sparse_vectors(k: np.ndarray, penalty: float, start: np.ndarray,
                   iterations: int) -> tuple[np.ndarray, np.ndarray]:
    """One pair of sparse canonical vectors of the cross product matrix."""
    v = start
    for _ in range(iterations):
        u = shrink_to(k @ v, max(1.0, penalty * math.sqrt(k.shape[0])))
        v = shrink_to(k.T @ u, max(1.0, penalty * math.sqrt(k.shape[1])))
    return u, v


def _correlation(u, v, k, xx, yy) -> float:
    spread = math.sqrt(max(u @ xx @ u, 0.0)) * math.sqrt(max(v @ yy @ v, 0.0))
    return float(u @ k @ v / spread) if spread else 0.0


def _complete(name: str) -> Column:
    missing = F.raise_error(F.lit("integrate_cca needs complete cells")).cast("double")
    return F.coalesce(double(name), missing)


def integrate_cca(x: DataFrame, y: DataFrame, permutations: int = 35, iterations: int = 5,
                  seed: int = 1) -> DataFrame:
    """``penalty, correlation, mean_permuted, p_value, z`` for each penalty.

    Rows are the shared observations, matched by id; a missing cell is an error. Columns are
    standardised. Features in rows: transpose first.
    """
    x_cols = [f"x:{c}" for c in value_columns(x)]
    y_cols = [f"y:{c}" for c in value_columns(y)]
    a = x.select(col(id_of(x)).cast("string").alias("_id"),
                 *[_complete(c).alias(f"x:{c}") for c in value_columns(x)])
    b = y.select(col(id_of(y)).cast("string").alias("_id"),
                 *[_complete(c).alias(f"y:{c}") for c in value_columns(y)])
    p, q = len(x_cols), len(y_cols)
    paired, plain = _row_pairs(a, b, permutations, seed)
    cross = cross_sums(paired, x_cols, y_cols, keys=["perm"], means_from=plain)
    xx = _centred_square(gram_arrays(plain, x_cols))
    yy = _centred_square(gram_arrays(plain, y_cols))
    sx, sy = np.sqrt(np.diag(xx)), np.sqrt(np.diag(yy))
    sx[sx == 0], sy[sy == 0] = 1.0, 1.0
    xx, yy = xx / np.outer(sx, sx), yy / np.outer(sy, sy)
    real = _centred_square(gram_arrays(plain, x_cols, y_cols)) / np.outer(sx, sy)
    start = np.linalg.svd(real, full_matrices=False)[2][0]

    def fit(cells: pd.DataFrame) -> pd.DataFrame:
        k = np.zeros((p, q))
        k[cells["i"], cells["j"]] = cells["sxy"] - cells["sx"] * cells["sy"] / cells["n"]
        k /= np.outer(sx, sy)
        return pd.DataFrame([
            (cells["perm"].iloc[0], float(c),
             _correlation(*sparse_vectors(k, c, start, iterations), k, xx, yy))
            for c in PENALTIES], columns=["perm", "penalty", "r"])

    true = [(float(c), _correlation(*sparse_vectors(real, c, start, iterations), real, xx, yy))
            for c in PENALTIES]
    fits = cross.groupBy("perm").applyInPandas(fit, "perm string, penalty double, r double")
    # p-value and z for each penalty; correlations are compared on the Fisher scale
    known = F.create_map(*[F.lit(v) for pair in true for v in pair])
    compared = fits.withColumn("correlation", known[F.col("penalty")])
    return compared.groupBy("penalty", "correlation").agg(
        F.avg("r").alias("mean_permuted"),
        F.avg((F.col("r") >= F.col("correlation")).cast("int")).alias("p_value"),
        F.avg(_fisher("r")).alias("_m"), F.stddev_samp(_fisher("r")).alias("_s")).select(
        "penalty", "correlation", "mean_permuted", "p_value",
        ((_fisher("correlation") - F.col("_m")) / (F.col("_s") + SD_FLOOR)).alias("z"))


def _fisher(name: str) -> Column:
    edge = 1 - 1e-12
    return F.atanh(F.greatest(F.lit(-edge), F.least(F.lit(edge), F.col(name))))
