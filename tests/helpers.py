"""Frames to and from pandas for comparison."""

import numpy as np
import pandas as pd


def ids(df):
    return sorted(r[0] for r in df.select(df.columns[0]).collect())


def to_pandas(df, key=None):
    key = key or df.columns[0]
    return df.toPandas().set_index(key).sort_index()


def matrix(spark, values, gaps=0.0, seed=0, prefix="r", cols=None):
    """A Spark matrix and its pandas twin, a share of the cells missing."""
    values = np.array(values, dtype=float)
    if gaps:
        values[np.random.default_rng(seed).random(values.shape) < gaps] = np.nan
    cols = cols or [f"c{i}" for i in range(values.shape[1])]
    frame = pd.DataFrame(values, index=[f"{prefix}{i:04d}" for i in range(len(values))],
                         columns=cols)
    rows = [(i, *[None if np.isnan(v) else float(v) for v in row])
            for i, row in zip(frame.index, values)]
    ddl = "id string, " + ", ".join(f"`{c}` double" for c in cols)
    return spark.createDataFrame(rows, ddl), frame


def pair_table(df, value="r"):
    """Symmetric lookup of a pair result."""
    out = {}
    for row in df.collect():
        out[row["x_id"], row["y_id"]] = out[row["y_id"], row["x_id"]] = row[value]
    return out
