"""Small helpers for labelled matrices held as DataFrames.

A matrix is a DataFrame whose first column is the row id; every other column is a value. All
operators take ``id_col=None`` and fall back to the first column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tessella.errors import EmptyResultError


def id_of(df: DataFrame, id_col: str | None = None) -> str:
    return id_col or df.columns[0]


def value_columns(df: DataFrame, id_col: str | None = None) -> list[str]:
    id_col = id_of(df, id_col)
    return [c for c in df.columns if c != id_col]


def numeric_columns(df: DataFrame, id_col: str | None = None) -> list[str]:
    id_col = id_of(df, id_col)
    return [f.name for f in df.schema.fields
            if f.name != id_col and isinstance(f.dataType, T.NumericType)]


def col(name: str) -> Column:
    """Column by its literal name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def double(name: str) -> Column:
    return col(name).cast("double")


def cells(df: DataFrame, id_col: str | None = None, cols: list[str] | None = None,
          row: str = "row_id", column: str = "col_id", value: str = "value") -> DataFrame:
    """Long form ``(row_id, col_id, value)``; missing cells stay as NULL rows.

    A matrix without value columns has no cells.
    """
    id_col = id_of(df, id_col)
    cols = cols or value_columns(df, id_col)
    if not cols:  # Spark has no unpivot of no columns
        return df.select(col(id_col).alias(row), F.lit("").alias(column),
                         F.lit(None).cast("double").alias(value)).where(F.lit(False))
    narrow = df.select(col(id_col).alias(row), *[double(c).alias(c) for c in cols])
    return narrow.unpivot([row], [col(c) for c in cols], column, value)


def wide_from_vector(df: DataFrame, id_col: str, vector: str, dim: int,
                     prefix: str = "d") -> DataFrame:
    """One double column per element of an array column."""
    return df.select(col(id_col), *[col(vector)[i].cast("double").alias(f"{prefix}{i}")
                                    for i in range(dim)])


def join_by_id(df: DataFrame, side: DataFrame, id_col: str, how: str = "inner") -> DataFrame:
    """Join with a result keyed by ``id`` as text, whatever the id column of the matrix is called."""
    side = side.withColumnRenamed("id", "_id_text")
    return df.join(side, col(id_col).cast("string") == F.col("_id_text"), how)


def ensure_not_empty(df: DataFrame, what: str = "operator") -> DataFrame:
    """Raise when nothing is left. Runs a one-row job, so callers opt in."""
    if len(df.columns) < 2 or df.isEmpty():
        raise EmptyResultError(f"{what} leaves no rows")
    return df


def balanced(terms: list[Column], op) -> Column:
    """Fold terms pairwise, so that the expression depth grows with log2 of their number."""
    while len(terms) > 1:
        terms = [op(terms[i], terms[i + 1]) if i + 1 < len(terms) else terms[i]
                 for i in range(0, len(terms), 2)]
    return terms[0]
