"""Column selection and renaming. Only a statistic of the values needs a job."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tessella.errors import EmptyResultError
from tessella.frame import col, double, id_of, numeric_columns, value_columns
from tessella.functions.aggregates import SIMPLE, Aggregate, aggregate_by
from tessella.functions.quantiles import quantiles

OPS: dict[str, Callable[[object, object], object]] = {
    name: getattr(operator, name) for name in ("gt", "ge", "lt", "le", "eq", "ne")}


def compare(op: str | Callable[[object, object], object]):
    return op if callable(op) else OPS[op]


def _keep(df: DataFrame, id_col: str, names: Iterable[str]) -> DataFrame:
    return df.select(col(id_col), *[col(c) for c in names])


def filter_cols_name_in(df: DataFrame, names: list[str], id_col: str | None = None) -> DataFrame:
    """Keep the listed columns in list order, after the id."""
    id_col = id_of(df, id_col)
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise KeyError(f"columns not found: {unknown}")
    return _keep(df, id_col, [c for c in names if c != id_col])


def filter_cols_name_not_in(df: DataFrame, names: list[str], errors: str = "ignore",
                            id_col: str | None = None) -> DataFrame:
    id_col = id_of(df, id_col)
    unknown = [c for c in names if c not in value_columns(df, id_col)]
    if unknown and errors != "ignore":
        raise KeyError(f"columns not found: {unknown}")
    return _keep(df, id_col, [c for c in value_columns(df, id_col) if c not in set(names)])


def _by_name(df: DataFrame, matches: Callable[[str], bool], drop: bool,
             id_col: str | None) -> DataFrame:
    id_col = id_of(df, id_col)
    return _keep(df, id_col, [c for c in value_columns(df, id_col) if matches(c) != drop])


def filter_cols_name_startswith(df: DataFrame, prefix: str, drop: bool = True,
                                id_col: str | None = None) -> DataFrame:
    return _by_name(df, lambda c: c.startswith(prefix), drop, id_col)


def filter_cols_name_endswith(df: DataFrame, suffix: str, drop: bool = True,
                              id_col: str | None = None) -> DataFrame:
    return _by_name(df, lambda c: c.endswith(suffix), drop, id_col)


def rename_cols_replace(df: DataFrame, old: str, new: str,
                        id_col: str | None = None) -> DataFrame:
    """Replace text in the column names; the id keeps its name."""
    id_col = id_of(df, id_col)
    names = [c if c == id_col else c.replace(old, new) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError("renaming makes two columns share a name")
    return df.toDF(*names)


def prefix_columns(df: DataFrame, stem: str, id_col: str | None = None) -> DataFrame:
    """Name every value column ``<stem>_<column>``."""
    id_col = id_of(df, id_col)
    return df.withColumnsRenamed({c: f"{stem}_{c}" for c in value_columns(df, id_col)})


def column_statistics(df: DataFrame, func: str | Aggregate, id_col: str | None = None,
                      prob: float | None = None) -> dict[str, float | None]:
    """One statistic per value column: one row to the driver.

    ``func`` is any aggregate name or expression; ``quantile`` needs ``prob``.
    """
    cols = value_columns(df, id_col)
    if callable(func):
        row = df.agg(*[func(double(c)).alias(c) for c in cols]).first()
    elif func == "quantile" and prob is None:
        raise ValueError("quantile needs prob")
    elif func in ("median", "quantile"):
        return column_quantile(df, 0.5 if func == "median" else prob, id_col)
    elif func in SIMPLE:
        row = df.agg(*[SIMPLE[func](double(c)).alias(c) for c in cols]).first()
    else:  # by name or expression, with all rows as one group
        one = df.select(F.lit(0).alias("_all"), *[double(c).alias(c) for c in cols])
        row = aggregate_by(one, ["_all"], cols, func).select(*[col(c) for c in cols]).first()
        row = row or [None] * len(cols)
    return {c: row[i] for i, c in enumerate(cols)}


def column_quantile(df: DataFrame, prob: float,
                    id_col: str | None = None) -> dict[str, float | None]:
    """Exact quantile of every value column, from bracketed ranks."""
    cols = value_columns(df, id_col)
    long = df.select(*[double(c).alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "_col", "_v")
    found = {r["_col"]: r["q"][0] for r in quantiles(
        long, "_v", [prob], ["_col"]).collect()}
    return {c: found.get(c) for c in cols}


def _linear_quantile(values: list[float], prob: float) -> float:
    ordered = sorted(values)
    at = prob * (len(ordered) - 1)
    low = int(at)
    high = min(low + 1, len(ordered) - 1)
    return ordered[low] + (ordered[high] - ordered[low]) * (at - low)


def _passing(stats: dict[str, float | None], op, value: float | None,
             quantile: float | None) -> list[str]:
    present = {c: v for c, v in stats.items() if v is not None}
    if quantile is not None:
        value = _linear_quantile(list(present.values()), quantile)
    return [c for c, v in present.items() if op(v, value)]


def filter_cols_by_func(df: DataFrame, func: str | Aggregate, op: str = "gt",
                        value: float | None = None, quantile: float | None = None,
                        id_col: str | None = None, prob: float | None = None) -> DataFrame:
    """Keep columns whose statistic passes the cutoff (a value, or a quantile of the statistics)."""
    if (value is None) == (quantile is None):
        raise ValueError("give either value or quantile")
    id_col = id_of(df, id_col)
    kept = _passing(column_statistics(df, func, id_col, prob), compare(op), value, quantile)
    if not kept:
        raise EmptyResultError("No columns remaining after filter_cols_by_func")
    return _keep(df, id_col, kept)


def min_variance(df: DataFrame, value: float | None = None, quantile: float | None = None,
                 response: str | None = "response", id_col: str | None = None) -> DataFrame:
    """Feature selection: keep features with sample variance at or above the cutoff.

    ``value`` wins over ``quantile``; id, response and ``response_name`` always stay.
    """
    if value is None and quantile is None:
        raise ValueError("min_variance needs value or quantile")
    id_col = id_of(df, id_col)
    carried = {id_col, response, "response_name"}
    features = [c for c in numeric_columns(df, id_col) if c not in carried]
    stats = column_statistics(df.select(col(id_col), *[col(c) for c in features]), "var", id_col)
    kept = set(_passing(stats, operator.ge, value, None if value is not None else quantile))
    dropped = {c for c in features if c not in kept}
    return df.select(*[col(c) for c in df.columns if c not in dropped])


def drop_zero_variance_cols(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Drop columns whose sample variance is zero or undefined."""
    id_col = id_of(df, id_col)
    stats = column_statistics(df, "var", id_col)
    return _keep(df, id_col, [c for c, v in stats.items() if v is not None and v > 0])


def drop_missing_cols(df: DataFrame, max_fraction: float = 0.1,
                      id_col: str | None = None) -> DataFrame:
    """Drop columns with more than the given fraction of missing cells."""
    id_col = id_of(df, id_col)
    cols = value_columns(df, id_col)
    share = df.agg(F.count(F.lit(1)), *[F.avg(col(c).isNull().cast("int")).alias(c) for c in cols]).first()[1:]
    return _keep(df, id_col, [c for i, c in enumerate(cols) if (share[i] or 0) <= max_fraction])


def informative_columns(df: DataFrame, exclude: Iterable[str] = (),
                        id_col: str | None = None) -> list[str]:
    """Columns with more than one distinct value, missing not counted.

    Two values differ exactly when the smallest and the largest do, so one min/max pass answers it
    without a distinct count.
    """
    skipped = set(exclude)
    cols = [c for c in value_columns(df, id_col) if c not in skipped]
    row = df.agg(*[(F.min(col(c)) < F.max(col(c))).alias(c) for c in cols]).first()
    return [c for i, c in enumerate(cols) if row[i]]


# metadata columns that only identify a sample (fixed values)
IDENTIFIER_COLUMNS = ("sample_name", "patient_id", "title")
