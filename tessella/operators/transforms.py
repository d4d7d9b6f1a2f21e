"""Cell transforms. Column totals and moments enter as one scalar subquery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col, double, id_of, value_columns
from tessella.functions.rowwise import row_mean, row_sd


def _map_cells(df: DataFrame, id_col: str | None, fn) -> DataFrame:
    id_col = id_of(df, id_col)
    return df.select(col(id_col), *[fn(c).alias(c) for c in value_columns(df, id_col)])


STATS = "_column_stats"


def with_column_stats(df: DataFrame, id_col: str | None, **stats) -> DataFrame:
    """Attach named aggregates of all value columns, from one pass, as arrays in column order.

    They sit in one column, so the subquery stands in the plan once and not once per cell.
    """
    cols = value_columns(df, id_col)
    row = df.agg(F.struct(*[F.array(*[fn(double(c)) for c in cols]).alias(name)
                            for name, fn in stats.items()]).alias("s")).scalar()
    return df.withColumn(STATS, row)


def _with_stats_cells(df: DataFrame, id_col: str | None, fn, **stats) -> DataFrame:
    id_col = id_of(df, id_col)
    return with_column_stats(df, id_col, **stats).select(col(id_col), *[
        fn(double(c), i, F.col(STATS)).alias(c) for i, c in enumerate(value_columns(df, id_col))])


def transform_cpm(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Share of the column total, in counts per million."""
    return _with_stats_cells(
        df, id_col, lambda x, i, s: F.try_divide(x, s["total"][i]) * 1e6, total=F.sum)


def transform_log2(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """log2 of each cell; missing where the cell is not positive."""
    return _map_cells(df, id_col, lambda c: F.log2(double(c)))


def transform_log2p(df: DataFrame, id_col: str | None = None) -> DataFrame:
    return _map_cells(df, id_col, lambda c: F.log2(double(c) + 1))


def transform_signed_log2(df: DataFrame, id_col: str | None = None) -> DataFrame:
    return _map_cells(df, id_col, lambda c: signed_log2(double(c)))


def signed_log2(x: Column) -> Column:
    return F.signum(x) * F.log2(F.abs(x) + 1)


def missing_indicator(df: DataFrame, id_col: str | None = None) -> DataFrame:
    return _map_cells(df, id_col, lambda c: col(c).isNull().cast("int"))


def transform_zscore(df: DataFrame, axis: int = 0, id_col: str | None = None) -> DataFrame:
    """Centre and scale by the population sd, per column (0) or per row (1).

    A zero sd gives missing cells.
    """
    if axis == 0:
        return _with_stats_cells(
            df, id_col, lambda x, i, s: F.try_divide(x - s["mean"][i], s["sd"][i]),
            mean=F.avg, sd=F.stddev_pop)
    if axis != 1:
        raise ValueError("axis is 0 (columns) or 1 (rows)")
    id_col = id_of(df, id_col)
    cols = value_columns(df, id_col)
    # the row's mean and sd in one column, computed once and not once per cell
    stats = F.struct(row_mean(cols).alias("mean"), row_sd(cols, ddof=0).alias("sd"))
    return df.withColumn(STATS, stats).select(col(id_col), *[
        F.try_divide(double(c) - F.col(STATS)["mean"], F.col(STATS)["sd"]).alias(c) for c in cols])
