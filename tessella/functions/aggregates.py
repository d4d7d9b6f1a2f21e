"""Aggregates by name.

``SIMPLE`` aggregates merge partial results, so Spark combines them before the shuffle. The
``HOLISTIC`` ones need the values themselves; ``aggregate_by`` sends groups above a row limit
through the bracketed quantile and the rest through ``percentile`` in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col
from tessella.functions.quantiles import quantiles
from tessella.functions.splitting import join_split
from tessella.runtime import cut_lineage

# scale that makes the median absolute deviation estimate a normal sd (fixed value)
NORMAL_MAD_SCALE = 0.674489750196082

HOT_GROUP_ROWS = 1_000_000

Aggregate = Callable[[Column], Column]


def _rows() -> Column:
    return F.count(F.lit(1))


def _nonzero(x: Column) -> Column:
    return F.count_if(F.coalesce(x != 0, F.lit(True)))


def _skew(x: Column) -> Column:
    n = F.count(x).cast("double")
    fixed = F.skewness(x) * F.try_divide(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n < 3, F.lit(None)).when(F.var_pop(x) == 0, F.lit(0.0)).otherwise(fixed)


def _kurt(x: Column) -> Column:
    n = F.count(x).cast("double")
    fixed = F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6)
    return F.when(n < 4, F.lit(None)).when(F.var_pop(x) == 0, F.lit(0.0)).otherwise(fixed)


SIMPLE: dict[str, Aggregate] = {
    "sum": lambda x: F.coalesce(F.sum(x), F.lit(0)),
    "prod": lambda x: F.coalesce(F.product(x), F.lit(1.0)),
    "min": F.min,
    "max": F.max,
    "mean": F.avg,
    "var": F.var_samp,
    "std": F.stddev_samp,
    "sem": lambda x: F.try_divide(F.stddev_samp(x), F.sqrt(F.count(x).cast("double"))),
    "count": F.count,
    "size": lambda x: _rows(),
    "nunique": F.count_distinct,
    "any": lambda x: F.coalesce(F.bool_or(x != 0), F.lit(False)),
    "all": lambda x: F.coalesce(F.bool_and(x != 0), F.lit(True)),
    "skew": _skew,
    "kurt": _kurt,
    "num_zero": lambda x: F.count_if(x == 0),
    "num_nonzero": _nonzero,
    "num_positive": lambda x: F.count_if(x > 0),
    "num_negative": lambda x: F.count_if(x < 0),
    "ratio_zero": lambda x: F.count_if(x == 0) / _rows(),
    "ratio_nonzero": lambda x: _nonzero(x) / _rows(),
    "ratio_positive": lambda x: F.count_if(x > 0) / _rows(),
    "ratio_negative": lambda x: F.count_if(x < 0) / _rows(),
    "sum_abs": lambda x: F.when(F.count(x) == _rows(), F.sum(F.abs(x))),
}
HOLISTIC = ("median", "quantile", "mad", "mad_median")
ORDERED = ("first", "last")

# aggregate functions an expression string may call
EXPRESSION_FUNCTIONS = frozenset(
    "abs avg coalesce count count_if exp greatest kurtosis least ln log2 max mean min nullif "
    "round skewness sqrt stddev stddev_pop stddev_samp sum try_divide var_pop var_samp "
    "variance".split())


def register_agg(name: str, fn: Aggregate) -> None:
    """Add a named aggregate: a function from a column to an aggregate column."""
    if name in HOLISTIC or name in ORDERED:
        raise ValueError(f"{name!r} is built in")
    SIMPLE[name] = fn


def known(name: str) -> bool:
    return name in SIMPLE or name in HOLISTIC or name in ORDERED


def expression_aggregate(text: str) -> Callable[[str], Column]:
    """A Spark SQL aggregate over ``x``, e.g. ``max(x) - min(x)``, from allowed functions."""
    calls = re.findall(r"([A-Za-z_]\w*)\s*\(", text)
    words = set(re.findall(r"[A-Za-z_]\w*", text)) - set(calls) - {"x"}
    if not calls or words or not set(calls) <= EXPRESSION_FUNCTIONS:
        raise ValueError(f"expression not allowed: {text!r}")
    return lambda name: F.expr(re.sub(r"\bx\b", lambda _: f"`{name}`", text))


def hot_groups(df: DataFrame, keys: Sequence[str],
               hot_rows: int = HOT_GROUP_ROWS) -> DataFrame | None:
    """Keys of groups too large for one buffer, or None; one job counts the rows per group.

    The row limit is fixed; the groups above it, however many, are joined and not broadcast. They
    are at most one for every ``hot_rows`` rows, and written once.
    """
    sizes = df.groupBy(*[col(k) for k in keys]).agg(_rows().alias("_rows"))
    hot = cut_lineage(sizes.where(F.col("_rows") > hot_rows).select(*[col(k) for k in keys]))
    return None if hot.isEmpty() else hot


def group_quantile(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prob: float = 0.5,
                   hot: DataFrame | None = None) -> DataFrame:
    """Exact quantile of each column per group.

    Groups of ordinary size take one pass of ``percentile``; the ``hot`` ones go
    through bracketed ranks, which hold no group in one task.
    """
    keys, cols = list(keys), list(cols)
    kcols = [col(k) for k in keys]
    df = df.select(*kcols, *[col(c).cast("double").alias(c) for c in cols])
    rest = df if hot is None else join_split(df, hot, keys, "left_anti")
    small = rest.groupBy(*kcols).agg(*[F.percentile(col(c), F.lit(prob)).alias(c) for c in cols])
    if hot is None:
        return small
    large = (join_split(df, hot, keys, "left_semi")
             .unpivot(kcols, [col(c) for c in cols], "_col", "_v"))
    found = quantiles(large, "_v", [prob], [*keys, "_col"])
    wide = found.groupBy(*kcols).agg(
        *[F.max(F.when(F.col("_col") == c, F.col("q")[0])).alias(c) for c in cols])
    return small.unionByName(hot.join(wide, keys, "left"))


def _with_centre(df: DataFrame, centre: DataFrame, keys: list[str], hot: DataFrame | None) -> DataFrame:
    """Every row and what its group has in common; the rows of the hot groups in many parts."""
    if hot is None:
        return df.join(centre, keys)
    rest = join_split(df, hot, keys, "left_anti").join(centre, keys)
    large = join_split(join_split(df, hot, keys, "left_semi"), centre.join(hot, keys, "left_semi"), keys)
    return rest.unionByName(large)


def _mean_deviation(df: DataFrame, keys: list[str], cols: list[str],
                    hot: DataFrame | None) -> DataFrame:
    centre = df.groupBy(*[col(k) for k in keys]).agg(
        F.struct(*[F.avg(col(c)).alias(c) for c in cols]).alias("_m"))
    return _with_centre(df, centre, keys, hot).groupBy(*[col(k) for k in keys]).agg(
        *[F.avg(F.abs(col(c) - F.col("_m")[c])).alias(c) for c in cols])


def _median_deviation(df: DataFrame, keys: list[str], cols: list[str],
                      hot: DataFrame | None) -> DataFrame:
    """Median of the absolute deviations from the median, scaled; a gap in a group voids it."""
    kcols = [col(k) for k in keys]
    centre = group_quantile(df, keys, cols, 0.5, hot).select(
        *kcols, F.struct(*[col(c) for c in cols]).alias("_m"))
    # a deviation is missing where its value is, and counts as such below
    spread = _with_centre(df, centre, keys, hot).select(
        *kcols, *[F.abs(col(c) - F.col("_m")[c]).alias(c) for c in cols])
    scaled = group_quantile(spread, keys, cols, 0.5, hot)
    whole = spread.groupBy(*kcols).agg(
        F.struct(*[(F.count(col(c)) == _rows()).alias(c) for c in cols]).alias("_whole"))
    return scaled.join(whole, keys).select(
        *kcols, *[F.when(F.col("_whole")[c], col(c) / NORMAL_MAD_SCALE).alias(c) for c in cols])


def aggregate_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                 func: str | Aggregate, *, prob: float = 0.5, order_col: str | None = None,
                 hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """One aggregate of every column per group; rows with a missing key are left out.

    Lazy, but for the holistic ones, where one job looks for groups above ``hot_rows`` first.

    ``func`` is a name, an expression over ``x`` or a function of a column (a grouped-aggregate
    pandas UDF is one as well). ``first`` and ``last`` need ``order_col``.
    """
    keys, cols = list(keys), list(cols)
    df = df.dropna(subset=keys)
    kcols = [col(k) for k in keys]
    if callable(func):
        return df.groupBy(*kcols).agg(*[func(col(c)).alias(c) for c in cols])
    if func in SIMPLE:
        return df.groupBy(*kcols).agg(*[SIMPLE[func](col(c)).alias(c) for c in cols])
    if func in ORDERED:
        if order_col is None:
            raise ValueError(f"{func} needs order_col: rows have no order of their own")
        pick = F.min_by if func == "first" else F.max_by
        return df.groupBy(*kcols).agg(
            *[pick(col(c), F.when(col(c).isNotNull(), col(order_col))).alias(c) for c in cols])
    if func in ("median", "quantile"):
        return group_quantile(df, keys, cols, 0.5 if func == "median" else prob,
                              hot_groups(df, keys, hot_rows))
    if func == "mad":
        return _mean_deviation(df, keys, cols, hot_groups(df, keys, hot_rows))
    if func == "mad_median":
        return _median_deviation(df, keys, cols, hot_groups(df, keys, hot_rows))
    if "(" in func:
        made = expression_aggregate(func)
        return df.groupBy(*kcols).agg(*[made(c).alias(c) for c in cols])
    raise ValueError(f"unknown aggregate {func!r}; known: "
                     f"{sorted([*SIMPLE, *HOLISTIC, *ORDERED])}")


def aggregate_many(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
                   funcs: Sequence[str], **options) -> DataFrame:
    """Several aggregates at once, as ``<col>_<func>``; the simple ones share one pass."""
    keys, cols = list(keys), list(cols)
    df = df.dropna(subset=keys)
    simple = [f for f in funcs if f in SIMPLE]
    frames = []
    if simple:
        frames.append(df.groupBy(*[col(k) for k in keys]).agg(
            *[SIMPLE[f](col(c)).alias(f"{c}_{f}") for f in simple for c in cols]))
    for f in funcs:
        if f not in simple:
            part = aggregate_by(df, keys, cols, f, **options)
            frames.append(part.select(*[col(k) for k in keys],
                                      *[col(c).alias(f"{c}_{f}") for c in cols]))
    out = frames[0]
    for part in frames[1:]:
        out = out.join(part, keys)
    return out.select(*[col(k) for k in keys], *[col(f"{c}_{f}") for c in cols for f in funcs])
