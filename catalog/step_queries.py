"""Named steps over the given tables: sets from a file, references, reports, own aggregates, files in parts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog.inputs import (PART_SETS, PART_TOTALS, TOTALS, TYPES, USER_TYPES, USER_WEEKDAYS, WEEKDAYS, part_sets,
                            part_totals, table, user_types, user_weekdays, with_ctes)

from catalog.matrix import BOTH, pair_sql
from catalog.registry import query, r, rounded
from tessella.errors import EmptyResultError
from tessella.functions import aggregates
from tessella.operators import aggregate, joins
from tessella.plans import steps
from tessella.runtime import checkpoint_dir

SUMS = ", ".join(f"sum({c}) AS {c}" for c in TOTALS)


@query("aggregate_gene_sets", with_ctes(PART_TOTALS, """b AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1
  HAVING count(*) > 7)""", f"""SELECT p_brand AS set_name, {SUMS} FROM pt JOIN part ON part = CAST(p_partkey AS VARCHAR)
WHERE p_brand IN (SELECT p_brand FROM b) GROUP BY 1"""))
def _(spark, sf):
    path = f"{checkpoint_dir(spark)}/sets-{uuid.uuid4().hex}.gmt"
    sets = table(spark, sf, "part").groupBy("p_brand").agg(
        F.concat_ws("\t", F.collect_list(F.col("p_partkey").cast("string"))).alias("members"))
    sets.select(F.concat_ws("\t", "p_brand", F.lit("parts"), "members").alias("value")).write.text(path)
    data = {"name": "totals", "data": part_totals(spark, sf),
            "actions": [{"aggregate_gene_sets": {"id": "by_set", "gmt": path, "min_size": 7}}]}
    return steps.run(spark, [data])["by_set"]


# a member in several lines: the last line of a mapping counts, the first of a set mapping, all with many
@query("map_ids_last_line", with_ctes(PART_TOTALS, """m AS (SELECT CAST(l_partkey AS VARCHAR) AS f, l_suppkey AS t,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem)""",
                                      f"SELECT CAST(t AS VARCHAR) AS part, {SUMS} FROM pt JOIN m ON f = part AND n = 1 GROUP BY 1"))
def _(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("from"), F.col("l_suppkey").cast("string").alias("to"),
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("position"))
    return aggregate.map_ids(part_totals(spark, sf), lines, "from", "to", "sum")


@query("map_sets_to_many", with_ctes(PART_SETS, """t AS (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS f,
  CAST(l_suppkey AS VARCHAR) AS t FROM lineitem)""", """SELECT set_name, t AS member, count(*) AS n FROM ps
JOIN t ON f = member GROUP BY 1, 2"""))
def _(spark, sf):
    # a row per member: an array would hold all members of a set in one row, and they grow with the parts
    sets = part_sets(spark, sf).withColumns({"description": F.lit(""), "position": F.lit(None).cast("int")})
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("part"),
                                                F.col("l_suppkey").cast("string").alias("supplier")).distinct()
    found = aggregate.map_members(sets, lines, "part", "supplier", many=True)
    return found.groupBy("set_name", "member").agg(F.count("*").alias("n"))


@query("merge_features_overlapping", with_ctes(USER_TYPES, f"""SELECT a.user_id, true AS refused, {", ".join(
    f"a.t_{t} AS a_t_{t}, b.t_{t} AS b_t_{t}" for t in TYPES)} FROM ut a JOIN ut b ON a.user_id = b.user_id"""))
def _(spark, sf):
    """Equal column names are refused; with prefixes the tables merge."""
    both = {"a": user_types(spark, sf), "b": user_types(spark, sf)}
    try:
        joins.merge_features(both, include_column_prefix=False)
        refused = False
    except ValueError:
        refused = True
    return joins.merge_features(both).withColumn("refused", F.lit(refused))


@query("training_set_without_shared_ids", """SELECT count(*) AS users, count(*) FILTER (k.c_custkey IS NOT NULL) = 0 AS refused
FROM (SELECT DISTINCT 'u' || CAST(user_id AS VARCHAR) AS u FROM events) e LEFT JOIN
(SELECT CAST(c_custkey AS VARCHAR) AS c_custkey FROM customer) k ON k.c_custkey = u""")
def _(spark, sf):
    """Ids that agree nowhere are refused: users by their id with a letter, customers by number."""
    users = user_types(spark, sf).withColumn("user_id", F.concat(F.lit("u"), "user_id"))
    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string"), "c_acctbal")
    try:
        joins.training_set({"u": users}, customers, allow_mismatched_indices=True, check_shared=True)
        refused = False
    except EmptyResultError:
        refused = True
    return users.agg(F.count("*").alias("users")).withColumn("refused", F.lit(refused))


@query("aggregate_by_own_function", with_ctes(PART_SETS, PART_TOTALS, f"""SELECT set_name, {", ".join(
    f"{r(f'max({c}) - min({c})')} AS {c}" for c in TOTALS)} FROM ps JOIN pt ON part = member GROUP BY 1"""))
def _(spark, sf):
    aggregates.register_agg("span", lambda x: F.max(x) - F.min(x))
    return rounded(aggregate.set_apply(part_totals(spark, sf), part_sets(spark, sf), "span"))


def _two_datasets(spark, sf):
    return [
        {"name": "types", "data": user_types(spark, sf), "actions": [
            {"integrate_cross_cor": {"id": "crossed", "dataset": "days"}},
            {"filter_cols_name_in": {"names": []}}]},
        {"name": "days", "data": user_weekdays(spark, sf), "actions": [
            {"filter_rows_col_not_na": {"id": "sundays", "col": "w1", "reports": ["general_eda"]}}]}]


@query("step_that_refers_to_another", with_ctes(*BOTH, "p AS (" + pair_sql("lx", "ly", same=False) + ")",
                                                "SELECT y_id, " + ", ".join(
    f"max(CASE WHEN x_id = 't_{c}' THEN r END) AS t_{c}" for c in TYPES) + " FROM p GROUP BY 1"))
def _(spark, sf):
    data = _two_datasets(spark, sf)
    data[0]["actions"] = data[0]["actions"][:1]
    found = rounded(steps.run(spark, data)["crossed"])
    return found.select("y_id", *[f"t_{t}" for t in TYPES])


@query("step_with_report", with_ctes(USER_WEEKDAYS, f"""SELECT count(*) AS num_rows,
  CAST({len(WEEKDAYS)} AS BIGINT) AS num_cols FROM uw WHERE w1 IS NOT NULL"""))
def _(spark, sf):
    return steps.run(spark, _two_datasets(spark, sf)[1:])["sundays/profile/dimensions"]


@query("integration_entries", with_ctes(*BOTH, pair_sql("lx", "ly", same=False)))
def _(spark, sf):
    results = steps.run(spark, [{"name": "types", "data": user_types(spark, sf)},
                                {"name": "days", "data": user_weekdays(spark, sf)}])
    return rounded(steps.integrate(results, [{"cross_cor": {"id": "both", "datasets": ["types", "days"]}}])["both"])


COMBINED = {"filter1": "filter_rows_col_gt", "fargs1": {"col": "qty", "value": 700},
            "filter2": "filter_rows_col_gt", "fargs2": {"col": "balance", "quantile": 0.5}}


def _combined(name: str, word: str) -> None:
    @query(f"chain_{name}", with_ctes(PART_TOTALS, f"""SELECT * FROM pt WHERE qty > 700
  {word} balance > (SELECT quantile_cont(balance, 0.5) FROM pt)"""))
    def _(spark, sf):
        data = {"name": "totals", "data": part_totals(spark, sf), "actions": [{name: {"id": "kept", **COMBINED}}]}
        return steps.run(spark, [data])["kept"]


_combined("filter_and", "AND")
_combined("filter_or", "OR")

