"""Cell transforms and shape changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (DAYS, LINE_CELLS, LINES, MONTHS, TYPES, USER_DAYS, lines, long_sql,
                            part_months, part_months_sql, part_totals, PART_TOTALS, TOTALS, table,
                            user_days, with_ctes)
from catalog.registry import query, r, rounded
from tessella.operators import shape, transforms


def _cells(cols, expression, id_col, source) -> str:
    made = ", ".join(f"{r(expression.format(c=c))} AS {c}" for c in cols)
    return f"SELECT {id_col}, {made} FROM {source}"


@query("transform_cpm", with_ctes(LINES, _cells(
    LINE_CELLS, "{c} / (SELECT sum({c}) FROM li) * 1e6", "row_id", "li")))
def _(spark, sf):
    return rounded(transforms.transform_cpm(lines(spark, sf)))


@query("transform_log2", with_ctes(LINES, _cells(
    LINE_CELLS, "CASE WHEN {c} > 0 THEN log2({c}) END", "row_id", "li")))
def _(spark, sf):
    return rounded(transforms.transform_log2(lines(spark, sf)))


@query("transform_log2p", with_ctes(LINES, _cells(LINE_CELLS, "log2({c} + 1)", "row_id", "li")))
def _(spark, sf):
    return rounded(transforms.transform_log2p(lines(spark, sf)))


@query("transform_zscore_columns", with_ctes(LINES, _cells(
    LINE_CELLS, "({c} - (SELECT avg({c}) FROM li)) / (SELECT stddev_pop({c}) FROM li)",
    "row_id", "li")))
def _(spark, sf):
    return rounded(transforms.transform_zscore(lines(spark, sf)))


ROW_STATS = f"""us AS (SELECT *, list_avg([{', '.join(DAYS)}]) AS mean,
  list_stddev_pop([{', '.join(DAYS)}]) AS sd FROM ud)"""


@query("transform_zscore_rows", with_ctes(USER_DAYS, ROW_STATS, _cells(
    DAYS, "({c} - mean) / nullif(sd, 0)", "user_id", "us")))
def _(spark, sf):
    return rounded(transforms.transform_zscore(user_days(spark, sf), axis=1))


@query("transform_signed_log2", with_ctes(PART_TOTALS, _cells(
    TOTALS, "sign({c}) * log2(abs({c}) + 1)", "part", "pt")))
def _(spark, sf):
    return rounded(transforms.transform_signed_log2(part_totals(spark, sf)))


@query("missing_indicator", with_ctes(USER_DAYS, "SELECT user_id, " + ", ".join(
    f"CAST({d} IS NULL AS INT) AS {d}" for d in DAYS) + " FROM ud"))
def _(spark, sf):
    return transforms.missing_indicator(user_days(spark, sf))


# --- shape ---

BRANDS = [f"Brand#{i}" for i in range(1, 26)]


@query("transpose_data", with_ctes(
    part_months_sql("bm", "p_brand"), long_sql("l", "bm", "p_brand", MONTHS),
    "SELECT col_id AS p_brand, " + ", ".join(
        f"max(CASE WHEN row_id = '{b}' THEN value END) AS \"{b}\"" for b in BRANDS)
    + " FROM l GROUP BY 1"))
def _(spark, sf):
    return shape.transpose_data(part_months(spark, sf, "p_brand"), names=BRANDS)


@query("pivot_wide", "SELECT user_id, " + ", ".join(
    f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in TYPES)
    + " FROM events GROUP BY 1")
def _(spark, sf):
    top = table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.max("value").alias("value"))
    return shape.pivot_wide(top, "event_type", "value", "user_id")


@query("unpivot", with_ctes(USER_DAYS, long_sql("l", "ud", "user_id", DAYS),
                            "SELECT row_id AS user_id, col_id, value FROM l"))
def _(spark, sf):
    return shape.unpivot(user_days(spark, sf))
