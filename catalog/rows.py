"""Row filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (DAYS, LINE_CELLS, LINES, USER_DAYS, lines, part_months,
                            part_months_sql, part_totals, PART_TOTALS, MONTHS, table, user_days,
                            with_ctes)
from catalog.registry import query, r, rounded
from tessella.functions.rowwise import row_mean
from tessella.operators import correlate, rows

SUM = " + ".join(f"coalesce({c}, 0)" for c in LINE_CELLS)
# population variance of the four cells, two passes
MEAN = f"(({SUM}) / 4)"
VAR = "((" + " + ".join(f"({c} - {MEAN}) * ({c} - {MEAN})" for c in LINE_CELLS) + ") / 4)"
NONZERO = " + ".join(f"CAST({c} <> 0 AS INT)" for c in LINE_CELLS)
MISSING = " + ".join(f"CAST({d} IS NULL AS INT)" for d in DAYS)


def _quantile(stat: str, source: str, q: float) -> str:
    return f"(SELECT quantile_cont({stat}, {q}) FROM {source})"


def _lines(where: str) -> str:
    return with_ctes(LINES, f"SELECT * FROM li WHERE {where}")


@query("filter_rows_sum_gt", _lines(f"{SUM} > 60000"))
def _(spark, sf):
    return rows.filter_rows_sum_gt(lines(spark, sf), value=60000)


@query("filter_rows_sum_gt_quantile", _lines(f"{SUM} > {_quantile(SUM, 'li', 0.9)}"))
def _(spark, sf):
    return rows.filter_rows_sum_gt(lines(spark, sf), quantile=0.9)


@query("filter_rows_var_gt", _lines(f"{VAR} > 1e8"))
def _(spark, sf):
    return rows.filter_rows_var_gt(lines(spark, sf), value=1e8)


@query("filter_rows_var_gt_quantile", _lines(f"{VAR} > {_quantile(VAR, 'li', 0.75)}"))
def _(spark, sf):
    return rows.filter_rows_var_gt(lines(spark, sf), quantile=0.75)


@query("filter_rows_by_func_mean_lt", _lines(f"{MEAN} < 2500"))
def _(spark, sf):
    return rows.filter_rows_by_func(lines(spark, sf), row_mean, "lt", value=2500)


@query("filter_rows_col_gt", _lines("l_extendedprice > 80000"))
def _(spark, sf):
    return rows.filter_rows_col_gt(lines(spark, sf), "l_extendedprice", value=80000)


@query("filter_rows_col_gt_quantile",
       _lines(f"l_extendedprice > {_quantile('l_extendedprice', 'li', 0.95)}"))
def _(spark, sf):
    return rows.filter_rows_col_gt(lines(spark, sf), "l_extendedprice", quantile=0.95)


@query("filter_rows_by_col_le", _lines("l_quantity <= 3"))
def _(spark, sf):
    return rows.filter_rows_by_col(lines(spark, sf), "l_quantity", "le", value=3)


@query("filter_rows_max_na", with_ctes(USER_DAYS, f"SELECT * FROM ud WHERE {MISSING} <= 2"))
def _(spark, sf):
    return rows.filter_rows_max_na(user_days(spark, sf), value=2)


@query("filter_rows_max_na_quantile", with_ctes(
    USER_DAYS, f"SELECT * FROM ud WHERE {MISSING} <= {_quantile(MISSING, 'ud', 0.25)}"))
def _(spark, sf):
    return rows.filter_rows_max_na(user_days(spark, sf), quantile=0.25)


@query("filter_rows_min_nonzero", _lines(f"{NONZERO} >= 4"))
def _(spark, sf):
    return rows.filter_rows_min_nonzero(lines(spark, sf), value=4)


@query("filter_rows_min_nonzero_quantile",
       _lines(f"{NONZERO} >= {_quantile(NONZERO, 'li', 0.05)}"))
def _(spark, sf):
    return rows.filter_rows_min_nonzero(lines(spark, sf), quantile=0.05)


# customers and the status of their largest order; some have none
BIG_ORDER = """bo AS (SELECT c.c_name, c.c_acctbal, o.o_orderstatus FROM customer c LEFT JOIN (
  SELECT o_custkey, max_by(o_orderstatus, o_totalprice) AS o_orderstatus FROM orders GROUP BY 1) o ON c.c_custkey = o.o_custkey)"""


def big_orders(spark, sf):
    top = (table(spark, sf, "orders").groupBy("o_custkey")
           .agg(F.max_by("o_orderstatus", "o_totalprice").alias("o_orderstatus")))
    customer = table(spark, sf, "customer")
    return customer.join(top, customer.c_custkey == top.o_custkey, "left").select(
        "c_name", "c_acctbal", "o_orderstatus")


@query("filter_rows_col_not_na",
       with_ctes(BIG_ORDER, "SELECT * FROM bo WHERE o_orderstatus IS NOT NULL"))
def _(spark, sf):
    return rows.filter_rows_col_not_na(big_orders(spark, sf), "o_orderstatus")


@query("filter_rows_col_in", with_ctes(BIG_ORDER, "SELECT * FROM bo WHERE o_orderstatus IN ('F', 'P')"))
def _(spark, sf):
    return rows.filter_rows_col_in(big_orders(spark, sf), "o_orderstatus", ["F", "P"])


@query("filter_rows_col_not_in", with_ctes(
    BIG_ORDER, "SELECT * FROM bo WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'P')"))
def _(spark, sf):
    return rows.filter_rows_col_not_in(big_orders(spark, sf), "o_orderstatus", ["F", "P"])


NAMES = ["Customer#000000003", "Customer#000000014", "Customer#000000015"]
NAME_LIST = ", ".join(f"'{n}'" for n in NAMES)
CUSTOMER = "SELECT c_name, c_acctbal FROM customer"


def customers(spark, sf):
    return table(spark, sf, "customer").select("c_name", "c_acctbal")


@query("filter_rows_name_in", f"{CUSTOMER} WHERE c_name IN ({NAME_LIST})")
def _(spark, sf):
    return rows.filter_rows_name_in(customers(spark, sf), NAMES)


@query("filter_rows_name_not_in", f"{CUSTOMER} WHERE c_name NOT IN ({NAME_LIST})")
def _(spark, sf):
    return rows.filter_rows_name_not_in(customers(spark, sf), NAMES)


@query("filter_rows_name_startswith", f"{CUSTOMER} WHERE NOT starts_with(c_name, 'Customer#0000001')")
def _(spark, sf):
    return rows.filter_rows_name_startswith(customers(spark, sf), "Customer#0000001")


@query("filter_rows_name_startswith_keep", f"{CUSTOMER} WHERE starts_with(c_name, 'Customer#0000001')")
def _(spark, sf):
    return rows.filter_rows_name_startswith(customers(spark, sf), "Customer#0000001", drop=False)


@query("filter_rows_name_endswith", f"{CUSTOMER} WHERE NOT suffix(c_name, '7')")
def _(spark, sf):
    return rows.filter_rows_name_endswith(customers(spark, sf), "7")


@query("filter_rows_name_endswith_keep", f"{CUSTOMER} WHERE suffix(c_name, '7')")
def _(spark, sf):
    return rows.filter_rows_name_endswith(customers(spark, sf), "7", drop=False)


@query("filter_and", _lines(f"l_quantity > 25 AND {SUM} > {_quantile(SUM, 'li', 0.5)}"))
def _(spark, sf):
    return rows.filter_and(lines(spark, sf), rows.col_is("l_quantity", "gt", value=25),
                           rows.sum_gt(quantile=0.5))


@query("filter_or", _lines("l_discount = 0 OR l_tax > 0.07"))
def _(spark, sf):
    return rows.filter_or(lines(spark, sf), rows.col_is("l_discount", "eq", value=0.0),
                          rows.col_is("l_tax", "gt", value=0.07))


EVENTS = "SELECT event_id, user_id, value FROM events"


def events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "value")


GROUP_MAX = "user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING max(value) >= 300)"


@query("filter_and_group", f"{EVENTS} WHERE value > 50 AND {GROUP_MAX}")
def _(spark, sf):
    return rows.filter_and(events(spark, sf), rows.col_is("value", "gt", value=50),
                           rows.group_is("user_id", "value", "max", "ge", value=300))


@query("filter_or_group", f"{EVENTS} WHERE value > 150 OR {GROUP_MAX}")
def _(spark, sf):
    return rows.filter_or(events(spark, sf), rows.col_is("value", "gt", value=150),
                          rows.group_is("user_id", "value", "max", "ge", value=300))


@query("complete_cases", with_ctes(USER_DAYS, f"SELECT * FROM ud WHERE {MISSING} = 0"))
def _(spark, sf):
    return rows.complete_cases(user_days(spark, sf))


@query("drop_zero_variance_rows", with_ctes(
    USER_DAYS, f"SELECT * FROM ud WHERE {len(DAYS)} - ({MISSING}) >= 2 AND "
    f"greatest({', '.join(DAYS)}) > least({', '.join(DAYS)})"))
def _(spark, sf):
    return rows.drop_zero_variance_rows(user_days(spark, sf))


# --- groups ---

def _groups(stat: str, test: str) -> str:
    return f"""WITH g AS (SELECT user_id, {stat} AS s FROM events GROUP BY 1)
{EVENTS} WHERE user_id IN (SELECT user_id FROM g WHERE {test})"""


@query("filter_rows_group_func_ge", _groups("max(value)", "s >= 200"))
def _(spark, sf):
    return rows.filter_rows_group_func_ge(events(spark, sf), "user_id", "value", "max", value=200)


@query("filter_rows_group_func_ge_median_quantile",
       _groups("median(value)", "s >= (SELECT quantile_cont(s, 0.8) FROM g)"))
def _(spark, sf):
    return rows.filter_rows_group_func_ge(events(spark, sf), "user_id", "value", "median",
                                          quantile=0.8)


@query("filter_rows_group_func_le", _groups("stddev_samp(value)", "s <= 45"))
def _(spark, sf):
    return rows.filter_rows_group_func_le(events(spark, sf), "user_id", "value", "std", value=45)


@query("filter_rows_group_func_le_quantile",
       _groups("max(value)", "s <= (SELECT quantile_cont(s, 0.3) FROM g)"))
def _(spark, sf):
    return rows.filter_rows_group_func_le(events(spark, sf), "user_id", "value", "max",
                                          quantile=0.3)


@query("filter_rows_group_expression", _groups("max(value) - min(value)", "s > 250"))
def _(spark, sf):
    return rows.filter_rows_by_group_func(events(spark, sf), "user_id", "value",
                                          "max(x) - min(x)", "gt", value=250)


@query("filter_rows_group_size_ge", _groups("count(*)", "s >= 66"))
def _(spark, sf):
    return rows.filter_rows_group_size_ge(events(spark, sf), "user_id", 66)


@query("filter_rows_group_mad", f"""WITH m AS (SELECT user_id, median(value) AS m FROM events GROUP BY 1),
g AS (SELECT e.user_id, median(abs(e.value - m.m)) / 0.674489750196082 AS s
  FROM events e JOIN m ON e.user_id = m.user_id GROUP BY 1)
{EVENTS} WHERE user_id IN (SELECT user_id FROM g WHERE s >= (SELECT quantile_cont(s, 0.5) FROM g))""")
def _(spark, sf):
    return rows.filter_rows_group_func_ge(events(spark, sf), "user_id", "value", "mad",
                                          quantile=0.5)


# --- annotation ---

KINDS = ["ECONOMY", "PROMO"]


def _annotated(word: str) -> str:
    return with_ctes(PART_TOTALS, f"""SELECT * FROM pt WHERE part {word} (
  SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_type IN ('ECONOMY', 'PROMO'))""")


def annotation(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("key"), "p_type")


@query("filter_rows_annotation_in", _annotated("IN"))
def _(spark, sf):
    return rows.filter_rows_annotation_in(part_totals(spark, sf), annotation(spark, sf), "key",
                                          "p_type", KINDS)


@query("filter_rows_annotation_not_in", _annotated("NOT IN"))
def _(spark, sf):
    return rows.filter_rows_annotation_not_in(part_totals(spark, sf), annotation(spark, sf), "key",
                                              "p_type", KINDS)


# --- correlated rows ---

PAIRS = f"""l AS (SELECT p_brand AS id, unnest({MONTHS}) AS c, unnest([{', '.join(MONTHS)}]) AS v FROM bm),
pr AS (SELECT a.id AS x, b.id AS y, corr(a.v, b.v) AS r FROM l a JOIN l b ON a.c = b.c
  WHERE a.id <> b.id GROUP BY 1, 2),
mr AS (SELECT x AS id, round(avg(abs(r)), 12) AS m FROM pr GROUP BY 1),
gone AS (SELECT DISTINCT CASE WHEN a.m > b.m OR (a.m = b.m AND a.id < b.id) THEN a.id ELSE b.id END AS id
  FROM pr JOIN mr a ON pr.x = a.id JOIN mr b ON pr.y = b.id WHERE x < y AND abs(r) > 0.5)"""


@query("filter_rows_max_correlation", with_ctes(
    part_months_sql("bm", "p_brand"), PAIRS,
    "SELECT * FROM bm WHERE p_brand NOT IN (SELECT id FROM gone)"))
def _(spark, sf):
    return correlate.filter_rows_max_correlation(part_months(spark, sf, "p_brand"), cutoff=0.5)


@query("row_correlations", with_ctes(
    part_months_sql("bm", "p_brand"),
    f"l AS (SELECT p_brand AS id, unnest({MONTHS}) AS c, unnest([{', '.join(MONTHS)}]) AS v FROM bm)",
    f"""SELECT a.id AS x_id, b.id AS y_id, {r('corr(a.v, b.v)')} AS r, count(*) AS n
FROM l a JOIN l b ON a.c = b.c WHERE a.id <= b.id GROUP BY 1, 2"""))
def _(spark, sf):
    return rounded(correlate.row_correlations(part_months(spark, sf, "p_brand")))
