"""Wide and long layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tessella.frame import cells, col, id_of, value_columns

DUPLICATE = "an index and column pair occurs more than once"


# columns that a wide layout may get from values
MOST_COLUMNS = 20_000


def unpivot(df: DataFrame, id_col: str | None = None, column: str = "col_id",
            value: str = "value") -> DataFrame:
    id_col = id_of(df, id_col)
    return df.unpivot([col(id_col)], [col(c) for c in value_columns(df, id_col)], column, value)


def pivot_wide(df: DataFrame, columns: str, values: str, index: str | None = None,
               names: list | None = None, most_columns: int = MOST_COLUMNS) -> DataFrame:
    """One row per index, one column per distinct ``columns`` value.

    A pair that occurs twice is an error, raised while the result is computed, so that no extra
    job checks for it. Without ``names`` one small job lists the distinct column values; more than
    ``most_columns`` of them are an error, as no plan holds so many columns: stay in the long layout.
    """
    index = id_of(df, index)
    long = df.select(col(index), col(columns).cast("string").alias("_column"),
                     col(values).alias("_value"))
    if names is None:
        names = [r[0] for r in long.select("_column").where(F.col("_column").isNotNull())
                 .distinct().orderBy("_column").limit(most_columns + 1).collect()]
        if len(names) > most_columns:
            raise ValueError(f"{columns} has more than {most_columns} distinct values")
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(DUPLICATE))).otherwise(
        F.first("_value"))
    kind = long.schema["_value"].dataType
    return (long.groupBy(col(index)).pivot("_column", names).agg(one.cast(kind)))


def transpose_data(df: DataFrame, id_col: str | None = None, names: list | None = None,
                   out_id: str | None = None) -> DataFrame:
    """Rows become columns. ``names`` are the row ids, looked up by one job when not given.

    In the long layout of ``cells`` a transpose is only a swap of the two names; this wide form is
    for matrices whose rows fit a schema.
    """
    id_col = id_of(df, id_col)
    long = cells(df, id_col)
    wide = pivot_wide(long, "row_id", "value", "col_id", names)
    return wide.withColumnRenamed("col_id", out_id or id_col)
