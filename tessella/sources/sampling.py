"""Exact-size, repeatable samples."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, functions as F

from tessella.frame import col, id_of, value_columns
from tessella.functions.quantiles import quantiles


def sample_rows(df: DataFrame, frac: float | None = None, n: int | None = None,
                seed: int = 1) -> DataFrame:
    """Exactly ``round(frac * rows)`` (or ``min(n, rows)``) rows without replacement.

    Rows are ordered by a seeded hash of their content. The hash of the last row to keep is found
    by exact selection, so the sample is a filter; no task sorts or holds it. Only rows that tie
    with that last hash, copies of one row, pass a limit.
    """
    if n is not None:
        rows = df.count()
        if n >= rows:
            return df
        frac = n / rows
    if frac >= 1:
        return df
    # 52 bits, so that the value is exact as a double
    keyed = df.withColumn("_h", F.shiftrightunsigned(
        F.xxhash64(F.lit(seed), *[col(c) for c in df.columns]), 12).cast("double"))
    found = quantiles(keyed, "_h", [frac], nth=True).first()["q"]
    last = F.lit(found[0] if found else None).cast("double")
    size = keyed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_h") < last).alias("under"),
                     F.count_if(F.col("_h") == last).alias("same")).first()
    wanted = n if n is not None else round(frac * size["n"])
    if wanted == 0:
        return df.limit(0)
    if size["under"] + size["same"] == wanted:
        return keyed.where(F.col("_h") <= last).drop("_h")
    under = keyed.where(F.col("_h") < last)
    ties = keyed.where(F.col("_h") == last).limit(wanted - size["under"])
    return under.unionByName(ties).drop("_h")


def sample_columns(df: DataFrame, frac: float | None = None, n: int | None = None, seed: int = 1,
                   id_col: str | None = None) -> DataFrame:
    """A seeded choice of value columns, kept in their order."""
    id_col = id_of(df, id_col)
    cols = value_columns(df, id_col)
    wanted = min(n, len(cols)) if n is not None else round(frac * len(cols))
    chosen = set(random.Random(seed).sample(cols, wanted))
    return df.select(col(id_col), *[col(c) for c in cols if c in chosen])


def display_sample(df: DataFrame, rows: int = 1000, columns: int = 1000, seed: int = 1,
                   id_col: str | None = None) -> DataFrame:
    """At most the given number of random rows and columns, for looking at a matrix."""
    return sample_rows(sample_columns(df, n=columns, seed=seed, id_col=id_col), n=rows, seed=seed)
