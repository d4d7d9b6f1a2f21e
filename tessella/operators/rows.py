"""Row filters.

Every ``*_is`` / ``rows_*`` predicate is a column, so filters combine with ``&`` and ``|`` and reach
the scan. Quantile cutoffs are scalar subqueries and stay lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col, id_of, value_columns
from tessella.functions.aggregates import Aggregate, aggregate_by
from tessella.functions.quantiles import cutoff
from tessella.functions.rowwise import (row_missing, row_nonzero, row_statistic, row_sum, row_var)
from tessella.operators.columns import compare
from tessella.runtime import cut_lineage

Predicate = Callable[[DataFrame], Column]


# --- predicates -------------------------------------------------------------------------------

def stat_is(func, op="gt", value=None, quantile=None, id_col=None, cols=None) -> Predicate:
    """A statistic of the row's cells against a value or a quantile over all rows."""
    def predicate(df: DataFrame) -> Column:
        stat = row_statistic(func, cols or value_columns(df, id_col))
        return compare(op)(stat, cutoff(df, stat, value, quantile))
    return predicate


def sum_gt(value=None, quantile=None, id_col=None) -> Predicate:
    return stat_is(row_sum, "gt", value, quantile, id_col)


def var_gt(value=None, quantile=None, id_col=None) -> Predicate:
    """Population variance of the present cells."""
    return stat_is(row_var, "gt", value, quantile, id_col)


def col_is(column, op="gt", value=None, quantile=None) -> Predicate:
    def predicate(df: DataFrame) -> Column:
        return compare(op)(col(column), cutoff(df, column, value, quantile))
    return predicate


def max_na(value=None, quantile=None, op="le", id_col=None) -> Predicate:
    return stat_is(row_missing, op, value, quantile, id_col)


def min_nonzero(value=None, quantile=None, op="ge", id_col=None) -> Predicate:
    """Cells other than 0, a missing cell counted as such."""
    return stat_is(row_nonzero, op, value, quantile, id_col)


def col_not_na(column) -> Predicate:
    return lambda df: col(column).isNotNull()


def col_in(column, values) -> Predicate:
    return lambda df: F.coalesce(col(column).isin(list(values)), F.lit(False))


def col_not_in(column, values) -> Predicate:
    """Rows with a missing value are kept."""
    return lambda df: ~F.coalesce(col(column).isin(list(values)), F.lit(False))


def name_in(names, id_col=None) -> Predicate:
    return lambda df: col(id_of(df, id_col)).isin(list(names))


def name_not_in(names, errors="ignore", id_col=None) -> Predicate:
    """With ``errors='raise'`` one job looks for names that are no row id: they are an error."""
    names = list(names)

    def predicate(df: DataFrame) -> Column:
        key = col(id_of(df, id_col))
        if errors == "raise":
            found = {r[0] for r in df.where(key.isin(names)).select(key).distinct().collect()}
            unknown = [n for n in names if n not in found]
            if unknown:
                raise KeyError(f"rows not found: {unknown}")
        return ~key.isin(names)
    return predicate


def name_startswith(prefix, drop=True, id_col=None) -> Predicate:
    def predicate(df: DataFrame) -> Column:
        hit = col(id_of(df, id_col)).startswith(prefix)
        return ~hit if drop else hit
    return predicate


def name_endswith(suffix, drop=True, id_col=None) -> Predicate:
    def predicate(df: DataFrame) -> Column:
        hit = col(id_of(df, id_col)).endswith(suffix)
        return ~hit if drop else hit
    return predicate


def group_is(group, column, func, op="gt", value=None, quantile=None, **options) -> Predicate:
    """Rows whose group passes, as an IN subquery: a semi join, under ``filter_or`` a flag."""
    return lambda df: col(group).isin(
        passing_groups(df, group, column, func, op, value, quantile, **options))


def annotation_in(annotation, key, column, values, id_col=None) -> Predicate:
    return lambda df: col(id_of(df, id_col)).isin(_annotated(annotation, key, column, values))


def annotation_not_in(annotation, key, column, values, id_col=None) -> Predicate:
    """Rows without any listed annotation, also those without an id."""
    def predicate(df: DataFrame) -> Column:
        hits = _annotated(annotation, key, column, values).where("_key is not null")
        return ~F.coalesce(col(id_of(df, id_col)).isin(hits), F.lit(False))
    return predicate


def complete(id_col=None) -> Predicate:
    """No cell is missing."""
    def predicate(df: DataFrame) -> Column:
        cells = [col(c).isNotNull() & ~F.isnan(col(c)) if kind in ("double", "float") else col(c).isNotNull()
                 for c, kind in df.dtypes if c != id_of(df, id_col)]
        return reduce(and_, cells, F.lit(True))
    return predicate


def all_of(*predicates: Predicate) -> Predicate:
    """Every predicate, cutoffs taken from the unfiltered frame."""
    return lambda df: reduce(and_, [p(df) for p in predicates], F.lit(True))


def any_of(*predicates: Predicate) -> Predicate:
    return lambda df: reduce(or_, [p(df) for p in predicates], F.lit(False))


def filter_and(df: DataFrame, *predicates: Predicate) -> DataFrame:
    return df.where(all_of(*predicates)(df))


def filter_or(df: DataFrame, *predicates: Predicate) -> DataFrame:
    return df.where(any_of(*predicates)(df))


# --- row filters ------------------------------------------------------------------------------

def filter_rows_by_func(df, func, op="gt", value=None, quantile=None, id_col=None, cols=None):
    return df.where(stat_is(func, op, value, quantile, id_col, cols)(df))


def filter_rows_sum_gt(df, value=None, quantile=None, id_col=None):
    return df.where(sum_gt(value, quantile, id_col)(df))


def filter_rows_var_gt(df, value=None, quantile=None, id_col=None):
    return df.where(var_gt(value, quantile, id_col)(df))


def filter_rows_by_col(df, column, op="gt", value=None, quantile=None):
    return df.where(col_is(column, op, value, quantile)(df))


def filter_rows_col_gt(df, column, value=None, quantile=None):
    return filter_rows_by_col(df, column, "gt", value, quantile)


def filter_rows_max_na(df, value=None, quantile=None, op="le", id_col=None):
    return df.where(max_na(value, quantile, op, id_col)(df))


def filter_rows_min_nonzero(df, value=None, quantile=None, op="ge", id_col=None):
    return df.where(min_nonzero(value, quantile, op, id_col)(df))


def filter_rows_col_not_na(df, column):
    return df.where(col_not_na(column)(df))


def filter_rows_col_in(df, column, values):
    return df.where(col_in(column, values)(df))


def filter_rows_col_not_in(df, column, values):
    return df.where(col_not_in(column, values)(df))


def filter_rows_name_in(df, names, id_col=None):
    return df.where(name_in(names, id_col)(df))


def filter_rows_name_not_in(df, names, errors="raise", id_col=None):
    """Drop rows by id. With ``errors='raise'`` a name that is no row id is an error."""
    return df.where(name_not_in(names, errors, id_col)(df))


def filter_rows_name_startswith(df, prefix, drop=True, id_col=None):
    return df.where(name_startswith(prefix, drop, id_col)(df))


def filter_rows_name_endswith(df, suffix, drop=True, id_col=None):
    return df.where(name_endswith(suffix, drop, id_col)(df))


def complete_cases(df: DataFrame, id_col: str | None = None) -> DataFrame:
    return df.dropna("any", subset=value_columns(df, id_col))


def drop_zero_variance_rows(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Rows with a positive sample variance; fewer than two cells leave it undefined."""
    return df.where(row_var(value_columns(df, id_col), ddof=1) > 0)


# --- group filters ----------------------------------------------------------------------------

def passing_groups(df: DataFrame, group: str, column: str, func: str | Aggregate, op="gt",
                   value=None, quantile=None, **options) -> DataFrame:
    """Groups whose statistic passes; a quantile is taken over the group statistics.

    Those are then written out once, one row per group, since cutoff and filter both need them.
    """
    narrow = df.select(col(group).alias("_g"), col(column).alias("_x"))
    func = "mad_median" if func == "mad" else func
    stats = aggregate_by(narrow, ["_g"], ["_x"], func, **options)
    if quantile is not None:
        stats = cut_lineage(stats)
    kept = stats.where(compare(op)(F.col("_x"), cutoff(stats, "_x", value, quantile)))
    return kept.select(F.col("_g").alias(group))


def filter_rows_by_group_func(df: DataFrame, group: str, column: str, func: str | Aggregate,
                              op="gt", value=None, quantile=None, **options) -> DataFrame:
    """Keep all rows of the passing groups; rows without a group are dropped."""
    return df.where(group_is(group, column, func, op, value, quantile, **options)(df))


def filter_rows_group_func_ge(df, group, column, func, value=None, quantile=None, **options):
    return filter_rows_by_group_func(df, group, column, func, "ge", value, quantile, **options)


def filter_rows_group_func_le(df, group, column, func, value=None, quantile=None, **options):
    return filter_rows_by_group_func(df, group, column, func, "le", value, quantile, **options)


def filter_rows_group_size_ge(df, group, size):
    return filter_rows_by_group_func(df, group, group, "size", "ge", size)


# --- filters by an annotation table -----------------------------------------------------------

def _annotated(annotation: DataFrame, key: str, column: str, values) -> DataFrame:
    return annotation.where(col(column).isin(list(values))).select(col(key).alias("_key"))


def filter_rows_annotation_in(df, annotation, key, column, values, id_col=None):
    """Rows whose id has one of the listed values in the annotation table."""
    return df.where(annotation_in(annotation, key, column, values, id_col)(df))


def filter_rows_annotation_not_in(df, annotation, key, column, values, id_col=None):
    hits = _annotated(annotation, key, column, values)
    return df.join(hits, col(id_of(df, id_col)) == F.col("_key"), "left_anti")
