"""Column filters, renaming and feature selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (DAYS, DIMS, EMBEDDINGS, USER_DAYS, embedding_wide, lines, LINES,
                            long_sql, table, user_days, with_ctes)
from catalog.registry import query, r, rounded
from tessella.frame import cells
from tessella.operators import columns

CUSTOMER = ["c_name", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]


def customer(spark, sf):
    return table(spark, sf, "customer").select(*CUSTOMER)


@query("filter_cols_name_in", "SELECT c_name, c_mktsegment, c_acctbal FROM customer")
def _(spark, sf):
    return columns.filter_cols_name_in(customer(spark, sf), ["c_mktsegment", "c_name", "c_acctbal"])


@query("filter_cols_name_not_in", "SELECT c_name, c_custkey, c_nationkey FROM customer")
def _(spark, sf):
    return columns.filter_cols_name_not_in(customer(spark, sf), ["c_acctbal", "c_mktsegment", "no"])


@query("filter_cols_name_startswith", "SELECT c_name, c_acctbal, c_mktsegment, c_nationkey FROM customer")
def _(spark, sf):
    return columns.filter_cols_name_startswith(customer(spark, sf), "c_cust")


@query("filter_cols_name_startswith_keep", "SELECT c_name, c_custkey FROM customer")
def _(spark, sf):
    return columns.filter_cols_name_startswith(customer(spark, sf), "c_cust", drop=False)


@query("filter_cols_name_endswith", "SELECT c_name, c_acctbal, c_mktsegment FROM customer")
def _(spark, sf):
    return columns.filter_cols_name_endswith(customer(spark, sf), "key")


@query("filter_cols_name_endswith_keep", "SELECT c_name, c_custkey, c_nationkey FROM customer")
def _(spark, sf):
    return columns.filter_cols_name_endswith(customer(spark, sf), "key", drop=False)


@query("rename_cols_replace", """SELECT c_name, c_custkey AS "c.custkey", c_nationkey AS "c.nationkey",
  c_acctbal AS "c.acctbal", c_mktsegment AS "c.mktsegment" FROM customer""")
def _(spark, sf):
    return columns.rename_cols_replace(customer(spark, sf), "c_", "c.")


@query("prefix_columns", """SELECT c_name, c_custkey AS cust_c_custkey, c_nationkey AS cust_c_nationkey,
  c_acctbal AS cust_c_acctbal, c_mktsegment AS cust_c_mktsegment FROM customer""")
def _(spark, sf):
    return columns.prefix_columns(customer(spark, sf), "cust")


# --- choices that depend on the values: the kept columns with their sums ---

def kept(df):
    return rounded(cells(df).groupBy("col_id").agg(F.sum("value").alias("total")), 4)


def _kept(cte: str, source: str, id_col: str, cols: list[str], test: str) -> str:
    return with_ctes(cte, long_sql("l", source, id_col, cols), f"""s AS (
  SELECT col_id, sum(value) AS total, var_samp(value) AS v, max(value) AS mx, median(value) AS md,
    count(*) - count(value) AS gaps, count(*) AS n FROM l GROUP BY 1)""",
                     f"SELECT col_id, {r('total', 4)} AS total FROM s WHERE {test}")


@query("filter_cols_by_func", _kept(USER_DAYS, "ud", "user_id", DAYS, "mx > 40000"))
def _(spark, sf):
    return kept(columns.filter_cols_by_func(user_days(spark, sf), "max", "gt", value=40000))


@query("filter_cols_by_func_quantile", _kept(
    USER_DAYS, "ud", "user_id", DAYS, "md <= (SELECT quantile_cont(md, 0.4) FROM s)"))
def _(spark, sf):
    return kept(columns.filter_cols_by_func(user_days(spark, sf), "median", "le", quantile=0.4))


@query("min_variance", _kept(EMBEDDINGS, "em", "vec_id", DIMS, "v >= 0.0155"))
def _(spark, sf):
    return kept(columns.min_variance(embedding_wide(spark, sf), value=0.0155))


@query("min_variance_quantile", _kept(
    EMBEDDINGS, "em", "vec_id", DIMS, "v >= (SELECT quantile_cont(v, 0.75) FROM s)"))
def _(spark, sf):
    return kept(columns.min_variance(embedding_wide(spark, sf), quantile=0.75))


@query("drop_zero_variance_cols", with_ctes(LINES, """z AS (SELECT *, 0.0 AS zero FROM li)""",
                                            long_sql("l", "z", "row_id", ["l_quantity", "l_discount", "zero"]),
                                            f"""SELECT col_id, {r('sum(value)', 4)} AS total FROM l
GROUP BY 1 HAVING max(value) > min(value)"""))
def _(spark, sf):
    df = lines(spark, sf).select("row_id", "l_quantity", "l_discount", F.lit(0.0).alias("zero"))
    return kept(columns.drop_zero_variance_cols(df))


@query("drop_missing_cols", _kept(USER_DAYS, "ud", "user_id", DAYS, "gaps <= 0.1 * n"))
def _(spark, sf):
    return kept(columns.drop_missing_cols(user_days(spark, sf), 0.1))


PART_COLS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query("informative_columns", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS col_id, count({c}) AS n FROM part HAVING count(DISTINCT {c}) > 1"
    for c in PART_COLS[1:]) + ")")
def _(spark, sf):
    part = table(spark, sf, "part").withColumn("same", F.lit("x"))
    names = columns.informative_columns(part, exclude=["p_name"])
    one = part.agg(*[F.count(c).alias(c) for c in names])
    return one.unpivot([], names, "col_id", "n")
