"""Aggregation by duplicate id, by named set, by cluster and by mapped id."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (DIMS, EMBEDDINGS, PART_SETS, PART_TOTALS, TOTALS, embedding_wide,
                            part_sets, part_totals, table, with_ctes)
from catalog.registry import query, r, rounded
from tessella.functions.quantiles import average_ranks, quantiles
from tessella.operators import aggregate

# --- duplicate ids: lines by part ---

COLS = ["l_quantity", "discount", "tax"]
SQL_AGG = {
    "sum": "coalesce(sum({c}), 0)",
    "mean": "avg({c})",
    "median": "median({c})",
    "min": "min({c})",
    "max": "max({c})",
    "var": "var_samp({c})",
    "std": "stddev_samp({c})",
    "sem": "stddev_samp({c}) / sqrt(count({c}))",
    "count": "count({c})",
    "size": "count(*)",
    "nunique": "count(DISTINCT {c})",
    "any": "bool_or({c} <> 0)",
    "all": "bool_and({c} <> 0)",
    "skew": "skewness({c})",
    "kurt": "kurtosis({c})",
    "first": "arg_min({c}, k)",
    "last": "arg_max({c}, k)",
    "quantile": "quantile_cont({c}, 0.9)",
    "prod": "product({c})",
    "num_zero": "count(*) FILTER ({c} = 0)",
    "num_nonzero": "count(*) FILTER ({c} IS NULL OR {c} <> 0)",
    "num_positive": "count(*) FILTER ({c} > 0)",
    "num_negative": "count(*) FILTER ({c} < 0)",
    "ratio_zero": "count(*) FILTER ({c} = 0) / count(*)",
    "ratio_nonzero": "count(*) FILTER ({c} IS NULL OR {c} <> 0) / count(*)",
    "ratio_positive": "count(*) FILTER ({c} > 0) / count(*)",
    "ratio_negative": "count(*) FILTER ({c} < 0) / count(*)",
    "sum_abs": "CASE WHEN count({c}) = count(*) THEN sum(abs({c})) END",
}
# results that are not doubles keep their type
EXACT = {"count", "size", "nunique", "any", "all", "num_zero", "num_nonzero", "num_positive",
         "num_negative"}
PLACES = 6


def agg_sql(func: str, c: str) -> str:
    expression = SQL_AGG[func].format(c=c)
    return f"{expression} AS {c}" if func in EXACT else f"{r(expression, PLACES)} AS {c}"


def by_part(spark, sf, key=False):
    """Quantity, and discount and tax in percent, of each line by part."""
    more = [F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("k")] if key else []
    return table(spark, sf, "lineitem").select(
        "l_partkey", "l_quantity", F.round(F.col("l_discount") * 100 + 0.0).alias("discount"),
        F.round(F.col("l_tax") * 100 + 0.0).alias("tax"), *more)


BY_PART = """bp AS (SELECT l_partkey, l_quantity, round(l_discount * 100 + 0.0) AS discount,
  round(l_tax * 100 + 0.0) AS tax, concat_ws('-', l_orderkey, l_linenumber, l_suppkey) AS k FROM lineitem)"""


def _duplicates(func: str) -> None:
    options = {"first": {"order_col": "k"}, "last": {"order_col": "k"},
               "quantile": {"prob": 0.9}}.get(func, {})
    cells = ", ".join(agg_sql(func, c) for c in COLS)

    @query(f"aggregate_duplicate_rows_{func}",
           with_ctes(BY_PART, f"SELECT l_partkey, {cells} FROM bp GROUP BY 1"))
    def _(spark, sf):
        df = by_part(spark, sf, key=bool(options.get("order_col")))
        return rounded(aggregate.aggregate_duplicate_rows(df, func, **options), PLACES)


for name in ("sum", "mean", "median", "min", "max", "var", "std", "sem", "count", "size",
             "nunique", "any", "all", "skew", "kurt", "first", "last", "quantile"):
    _duplicates(name)


@query("aggregate_duplicate_rows_prod", f"""SELECT l_partkey, {r('product(1 - l_discount)')} AS kept
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_partkey", (1 - F.col("l_discount")).alias("kept"))
    return rounded(aggregate.aggregate_duplicate_rows(df, "prod"))


@query("aggregate_duplicate_rows_mad", with_ctes(
    BY_PART, "m AS (SELECT l_partkey AS k2, " + ", ".join(f"avg({c}) AS m_{c}" for c in COLS)
    + " FROM bp GROUP BY 1)", "SELECT l_partkey, " + ", ".join(
        f"{r(f'avg(abs({c} - m_{c}))', PLACES)} AS {c}" for c in COLS)
    + " FROM bp JOIN m ON l_partkey = k2 GROUP BY 1"))
def _(spark, sf):
    return rounded(aggregate.aggregate_duplicate_rows(by_part(spark, sf), "mad"), PLACES)


@query("aggregate_rows_many", with_ctes(BY_PART, "SELECT l_partkey, " + ", ".join(
    f"{r(SQL_AGG[f].format(c=c), PLACES)} AS {c}_{f}" for c in COLS
    for f in ("sum", "var", "max", "median")) + " FROM bp GROUP BY 1"))
def _(spark, sf):
    return rounded(aggregate.aggregate_rows_many(
        by_part(spark, sf), ["sum", "var", "max", "median"]), PLACES)


# --- named sets: brands, types and sizes over part totals ---

JOINED = "j AS (SELECT set_name, pt.* FROM ps JOIN pt ON member = part)"


def _sets(func: str) -> None:
    cells = ", ".join(agg_sql(func, c) for c in TOTALS)

    @query(f"aggregate_sets_{func}", with_ctes(
        PART_TOTALS, PART_SETS, JOINED, f"SELECT set_name, {cells} FROM j GROUP BY 1"))
    def _(spark, sf):
        return rounded(aggregate.set_apply(part_totals(spark, sf), part_sets(spark, sf), func),
                       PLACES)


for name in ("sum", "min", "max", "mean", "median", "var", "std", "num_zero", "num_nonzero",
             "num_positive", "num_negative", "ratio_zero", "ratio_nonzero", "ratio_positive",
             "ratio_negative", "sum_abs"):
    _sets(name)


@query("aggregate_sets_mapped", with_ctes(PART_TOTALS, PART_SETS, f"""SELECT set_name, {", ".join(
    agg_sql("sum", c) for c in TOTALS)} FROM (
  SELECT set_name, pt.* FROM ps JOIN pt ON member = part WHERE starts_with(set_name, 'brand'))
GROUP BY 1"""))
def _(spark, sf):
    # sets that list part names by a code, translated back to the ids of the matrix
    part = table(spark, sf, "part")
    code = F.concat(F.lit("P"), F.col("p_partkey").cast("string"))
    sets = part.groupBy(F.concat(F.lit("brand "), "p_brand").alias("set_name")).agg(
        F.first("p_brand").alias("description"), F.collect_list(code).alias("members"))
    mapping = part.select(code.alias("code"), F.col("p_partkey").alias("part"))
    return rounded(aggregate.aggregate_sets(part_totals(spark, sf), sets, "sum", mapping, "code",
                                            "part"), PLACES)


@query("map_sets", """SELECT 'brand ' || p_brand AS set_name, p_brand AS description,
  count(DISTINCT p_type) AS n FROM part GROUP BY 1, 2""")
def _(spark, sf):
    part = table(spark, sf, "part")
    sets = part.groupBy(F.concat(F.lit("brand "), "p_brand").alias("set_name"),
                        F.col("p_brand").alias("description")).agg(
        F.sort_array(F.collect_set(F.col("p_partkey").cast("string"))).alias("members"))
    mapped = aggregate.map_sets(sets, part.select("p_partkey", "p_type"), "p_partkey", "p_type")
    return mapped.select("set_name", "description",
                         F.size(F.array_distinct("members")).cast("long").alias("n"))


def _clusters(func: str) -> None:
    cells = ", ".join(agg_sql(func, c) for c in DIMS)

    @query(f"cluster_apply_{func}", with_ctes(
        "lb AS (SELECT CAST(vec_id AS VARCHAR) AS id, label FROM embeddings)", EMBEDDINGS,
        f"""SELECT CAST(label AS VARCHAR) AS cluster, {cells} FROM em JOIN lb ON vec_id = id
GROUP BY 1"""))
    def _(spark, sf):
        labels = table(spark, sf, "embeddings").select(
            F.col("vec_id").cast("string").alias("vec_id"),
            F.col("label").cast("string").alias("cluster"))
        return rounded(aggregate.cluster_apply(embedding_wide(spark, sf), labels, func), PLACES)


for name in ("sum", "min", "num_positive"):
    _clusters(name)


@query("map_ids_collapse", f"""SELECT CAST(c_nationkey AS VARCHAR) AS customer,
  {r('sum(o_totalprice)', 2)} AS price, sum(n)::DOUBLE AS n
FROM (SELECT o_custkey, o_totalprice, 1 AS n FROM orders) JOIN customer ON o_custkey = c_custkey
GROUP BY 1""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("customer"), F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("n"))
    mapping = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("from"),
        F.col("c_nationkey").cast("string").alias("to"))
    return rounded(aggregate.map_ids(orders, mapping, "from", "to"), 2)


# --- quantiles and ranks on their own ---

@query("quantiles_of_all_prices", f"""SELECT {", ".join(
    f"{r(f'quantile_cont(l_extendedprice, {q})', 4)} AS q{int(q * 100)}"
    for q in (0.0, 0.25, 0.5, 0.9, 1.0))} FROM lineitem""")
def _(spark, sf):
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    found = quantiles(table(spark, sf, "lineitem"), "l_extendedprice", probs, accuracy=2000)
    return rounded(found.select(*[F.col("q")[i].alias(f"q{int(q * 100)}")
                                  for i, q in enumerate(probs)]), 4)


@query("quantiles_by_flag", f"""SELECT l_returnflag, {r('quantile_cont(l_extendedprice, 0.25)', 4)} AS q25,
  {r('median(l_extendedprice)', 4)} AS median FROM lineitem GROUP BY 1""")
def _(spark, sf):
    found = quantiles(table(spark, sf, "lineitem"), "l_extendedprice", [0.25, 0.5],
                      ["l_returnflag"], accuracy=1000, refine=True)
    return rounded(found.select("l_returnflag", F.col("q")[0].alias("q25"),
                                F.col("q")[1].alias("median")), 4)


@query("average_ranks_of_prices", """SELECT l_returnflag, l_quantity, avg(rn) AS rank FROM (
  SELECT l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rn
  FROM lineitem) GROUP BY 1, 2""")
def _(spark, sf):
    return average_ranks(table(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"])
