"""Statistics across the columns of one row, as plain column expressions (no shuffle)."""

from __future__ import annotations

from collections.abc import Callable
from operator import add

from pyspark.sql import Column, functions as F

from tessella.frame import balanced, double


def row_values(cols: list[str]) -> Column:
    """Present cells of the row as ``array<double>``."""
    return F.filter(F.array(*[double(c) for c in cols]), lambda x: x.isNotNull())


def row_sum(cols: list[str]) -> Column:
    return balanced([F.coalesce(double(c), F.lit(0.0)) for c in cols], add)


def row_missing(cols: list[str]) -> Column:
    return balanced([double(c).isNull().cast("int") for c in cols], add)


def row_nonzero(cols: list[str]) -> Column:
    """Cells other than 0; a missing cell counts."""
    return balanced([F.coalesce(double(c) != 0, F.lit(True)).cast("int") for c in cols], add)


def row_mean(cols: list[str]) -> Column:
    return F.try_divide(row_sum(cols), F.lit(len(cols)) - row_missing(cols))


def row_min(cols: list[str]) -> Column:
    return F.array_min(row_values(cols))


def row_max(cols: list[str]) -> Column:
    return F.array_max(row_values(cols))


def row_median(cols: list[str]) -> Column:
    ordered = F.array_sort(row_values(cols))
    return F.transform(F.array(ordered), lambda a: F.try_divide(
        F.get(a, F.floor((F.size(a) - 1) / 2).cast("int"))
        + F.get(a, F.floor(F.size(a) / 2).cast("int")), F.lit(2.0)))[0]


# columns up to which the deviations are written out; beyond, the expression would get too long to plan
WRITTEN_OUT = 16


def row_var(cols: list[str], ddof: int = 0) -> Column:
    """Variance over the present cells; NULL where ``n <= ddof``.

    Squared deviations from the mean, so nothing cancels: written out as one compiled sum for few
    columns, as a loop over an array for many.
    """
    n, mean = F.lit(len(cols)) - row_missing(cols), row_mean(cols)
    if len(cols) <= WRITTEN_OUT:
        off = [double(c) - mean for c in cols]
        squares = balanced([F.coalesce(d * d, F.lit(0.0)) for d in off], lambda a, b: a + b)
    else:
        squares = F.transform(F.array(mean), lambda m: F.aggregate(
            row_values(cols), F.lit(0.0), lambda a, x: a + (x - m) * (x - m)))[0]
    return F.when(n > ddof, squares / (n - ddof))


def row_sd(cols: list[str], ddof: int = 1) -> Column:
    return F.sqrt(row_var(cols, ddof))


ROW_STATISTICS: dict[str, Callable[[list[str]], Column]] = {
    "sum": row_sum,
    "mean": row_mean,
    "median": row_median,
    "min": row_min,
    "max": row_max,
    "var": row_var,
    "std": row_sd,
    "num_missing": row_missing,
    "num_nonzero": row_nonzero,
}


def row_statistic(func: str | Callable[[list[str]], Column], cols: list[str]) -> Column:
    if callable(func):
        return func(cols)
    if func not in ROW_STATISTICS:
        raise ValueError(f"unknown row statistic {func!r}; known: {sorted(ROW_STATISTICS)}")
    return ROW_STATISTICS[func](cols)
