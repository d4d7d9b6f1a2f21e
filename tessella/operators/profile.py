"""The numbers behind an exploratory report of a matrix, each as a small table.

Row statistics are expressions on the row, column statistics one aggregation; quantiles over all
cells go through the bracketed exact form. Nothing gathers the cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import cells, col, double, id_of, value_columns
from tessella.functions.quantiles import quantiles
from tessella.functions.rowwise import (row_max, row_mean, row_median, row_missing, row_sd)
from tessella.operators import correlate, project
from tessella.operators.joins import annotate
from tessella.operators.transforms import signed_log2

TOP = 10


def dimensions(df: DataFrame, id_col: str | None = None) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("num_rows"),
                  F.max(F.lit(len(value_columns(df, id_col)))).cast("long").alias("num_cols"))


def column_types(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Number of value columns per type; reads the schema only."""
    kinds: dict[str, int] = {}
    for name in value_columns(df, id_col):
        kind = df.schema[name].dataType.simpleString()
        kinds[kind] = kinds.get(kind, 0) + 1
    return df.sparkSession.createDataFrame(sorted(kinds.items()), "type string, num_cols long")


def value_histogram(df: DataFrame, bins: int = 50, log: bool = False,
                    id_col: str | None = None) -> DataFrame:
    """``bin, low, high, n`` over all present cells, raw or on the signed log2 scale."""
    cols = value_columns(df, id_col)
    raw = df.select(*[double(c).alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "col_id", "value").where(F.col("value").isNotNull())
    x = signed_log2(F.col("value")) if log else F.col("value")
    values = raw.select(x.alias("x"))
    ends = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("s")).scalar()
    lo, step = F.col("_e.lo"), (F.col("_e.hi") - F.col("_e.lo")) / bins
    place = F.when(step > 0, F.least(F.floor(F.try_divide(F.col("x") - lo, step)),
                                     F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    return (values.withColumn("_e", ends)
            .select(place.alias("bin"), lo.alias("lo"), step.alias("step"))
            .groupBy("bin", "lo", "step").agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.col("lo") + F.col("bin") * F.col("step")).alias("low"),
                    (F.col("lo") + (F.col("bin") + 1) * F.col("step")).alias("high"), "n"))


def value_summary(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Minimum, quartiles, mean and maximum over all cells."""
    cols = value_columns(df, id_col)
    long = df.select(*[double(c).alias(c) for c in cols]).unpivot(
        [], [col(c) for c in cols], "col_id", "value")
    ranks = quantiles(long, "value", [0.0, 0.25, 0.5, 0.75, 1.0]).scalar()
    # the mean comes from column sums, so the cells are not spread out a second time
    total = [F.sum(double(c)) for c in cols]
    n = [F.count(col(c)) for c in cols]
    return df.agg(F.try_divide(
        sum((F.coalesce(t, F.lit(0.0)) for t in total[1:]), F.coalesce(total[0], F.lit(0.0))),
        sum(n[1:], n[0])).alias("mean")).withColumn("_q", ranks).select(
        *[F.col("_q")[i].alias(name) for i, name in
          enumerate(("min", "q25", "median", "q75", "max"))], "mean")


def _cell_counts(df: DataFrame, cols: list[str], test) -> Column:
    counts = [F.count_if(test(double(c))) for c in cols]
    return sum(counts[1:], counts[0])


def sign_counts(df: DataFrame, id_col: str | None = None) -> DataFrame:
    """Zero, positive, negative and missing cells, in number and as percent of all cells."""
    cols = value_columns(df, id_col)
    tests = {"zero": lambda x: x == 0, "positive": lambda x: x > 0,
             "negative": lambda x: x < 0, "missing": lambda x: x.isNull()}
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 *[_cell_counts(df, cols, t).alias(n) for n, t in tests.items()])
    total = F.col("rows") * len(cols)
    return row.select(*[F.col(n).alias(f"num_{n}") for n in tests],
                      *[F.try_divide(F.col(n) * 100.0, total).alias(f"pct_{n}") for n in tests])


ROW_STATISTICS = {"missing": row_missing, "mean": row_mean, "median": row_median,
                  "max": row_max, "sd": row_sd}


def row_profile(df: DataFrame, stat: str, id_col: str | None = None) -> DataFrame:
    """``id, <stat>`` for every row: missing, mean, median, max or sd."""
    id_col = id_of(df, id_col)
    value = ROW_STATISTICS[stat](value_columns(df, id_col))
    return df.select(col(id_col).cast("string").alias("id"), value.alias(stat))


COLUMN_STATISTICS = {
    "missing": lambda c: F.count_if(col(c).isNull()),
    "mean": lambda c: F.avg(double(c)),
    "max": lambda c: F.max(double(c)),
    "sd": lambda c: F.stddev_samp(double(c)),
}


def column_profile(df: DataFrame, stat: str, id_col: str | None = None) -> DataFrame:
    """``id, <stat>`` for every value column."""
    cols = value_columns(df, id_col)
    if stat == "median":
        long = cells(df, id_col).select("col_id", "value")
        return quantiles(long, "value", [0.5], ["col_id"]).select(
            F.col("col_id").alias("id"), F.col("q")[0].alias("median"))
    one = df.agg(*[COLUMN_STATISTICS[stat](c).alias(c) for c in cols])
    return one.unpivot([], [col(c) for c in cols], "id", stat)


def profile_summary(profile: DataFrame) -> DataFrame:
    """``min, median, mean, max`` of a row or column profile."""
    stat = profile.columns[1]
    ranks = quantiles(profile, stat, [0.0, 0.5, 1.0]).scalar()
    return profile.agg(F.avg(col(stat)).alias("mean")).withColumn("_q", ranks).select(
        F.col("_q")[0].alias("min"), F.col("_q")[1].alias("median"), "mean",
        F.col("_q")[2].alias("max"))


def profile_top(profile: DataFrame, largest: bool = True, k: int = TOP,
                annotation: DataFrame | None = None) -> DataFrame:
    """The k largest or smallest of a profile, ties by id, with a side table's columns added."""
    stat = profile.columns[1]
    order = col(stat).desc_nulls_last() if largest else col(stat).asc_nulls_last()
    top = profile.orderBy(order, "id").limit(k)
    return top if annotation is None else annotate(top, annotation)


class Tables(dict):
    """Tables by name, some given as functions that make them when they are first asked for."""

    def __getitem__(self, name: str) -> DataFrame:
        found = super().__getitem__(name)
        if not isinstance(found, DataFrame) and callable(found):
            found = self[name] = found()
        return found

    def get(self, name: str, default=None):
        return self[name] if name in self else default

    def values(self):
        return [self[name] for name in self]

    def items(self):
        return [(name, self[name]) for name in self]

    def add(self, prefix: str, tables: "Tables") -> None:
        """Take over other tables under a prefix, as they are."""
        for name in tables:
            self[prefix + name] = dict.__getitem__(tables, name)


def _pairwise(df: DataFrame, id_col: str | None) -> dict[str, Callable[[], DataFrame]]:
    """Median correlations of rows and columns, their summaries and extremes, and component variances."""
    medians = {"row": lambda: correlate.row_median_correlations(df, id_col=id_col),
               "column": lambda: correlate.median_correlations(correlate.column_correlations(df, id_col=id_col))}
    kept: dict[str, DataFrame] = {}

    def of(side: str) -> DataFrame:
        if side not in kept:
            kept[side] = medians[side]()
        return kept[side]

    out = {}
    for side in medians:
        out[f"{side}_correlation"] = lambda side=side: correlate.correlation_summary(of(side))
        for which in ("highest", "lowest", "closest_to_zero"):
            out[f"{side}_correlation_{which}"] = lambda side=side, which=which: correlate.top_correlated(of(side), which)
        target = side + "s"
        out[f"pca_variance_{target}"] = lambda target=target: project.pca_variance(df, target, id_col=id_col)
    return out


def profile(df: DataFrame, id_col: str | None = None) -> Tables:
    """All report tables by name; each is computed only when used, those between rows or columns are
    not even planned before."""
    out = Tables(_pairwise(df, id_col))
    out |= {
        "dimensions": dimensions(df, id_col),
        "column_types": column_types(df, id_col),
        "histogram": value_histogram(df, id_col=id_col),
        "histogram_log2": value_histogram(df, log=True, id_col=id_col),
        "values": value_summary(df, id_col),
        "signs": sign_counts(df, id_col),
    }
    for side, make in (("row", row_profile), ("column", column_profile)):
        for stat in ROW_STATISTICS:
            table = make(df, stat, id_col)
            out[f"{side}_{stat}"] = profile_summary(table)
            out[f"{side}_{stat}_largest"] = profile_top(table)
            if stat != "missing":
                out[f"{side}_{stat}_smallest"] = profile_top(table, largest=False)
    return out
