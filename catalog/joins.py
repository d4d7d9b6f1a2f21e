"""Feature tables, training sets and annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.inputs import (TYPES, USER_TYPES, USER_WEEKDAYS, WEEKDAYS, part_totals,
                            PART_TOTALS, table, user_types, user_weekdays, with_ctes)
from catalog.registry import query, r, rounded
from tessella.operators import joins
from tessella.plans import steps

RESPONSES = ["biggest", "late"]


def response(spark, sf):
    """Per user: the largest value and the largest one of the second half of the month."""
    return table(spark, sf, "events").groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        F.max("value").alias("biggest"),
        F.max(F.when(F.dayofmonth("ts") > 29, F.col("value"))).alias("late"))


RESPONSE = """rs AS (SELECT CAST(user_id AS VARCHAR) AS user_id, max(value) AS biggest,
  max(CASE WHEN day(ts) > 29 THEN value END) AS late FROM events GROUP BY 1)"""

T_COLS = [f"t_{t}" for t in TYPES]
PREFIXED = ", ".join([f"ut.{c} AS type_{c}" for c in T_COLS]
                     + [f"uw.{c} AS day_{c}" for c in WEEKDAYS])
FEATURES = f"""ft AS (SELECT ut.user_id, {PREFIXED}
  FROM ut LEFT JOIN uw ON ut.user_id = uw.user_id)"""


def features(spark, sf):
    return {"type": user_types(spark, sf), "day": user_weekdays(spark, sf)}


@query("merge_features", with_ctes(USER_TYPES, USER_WEEKDAYS, FEATURES, "SELECT * FROM ft"))
def _(spark, sf):
    return joins.merge_features(features(spark, sf))


@query("merge_features_mismatched", with_ctes(
    USER_TYPES, "SELECT ut.*, c_acctbal, c_nationkey FROM ut LEFT JOIN customer ON user_id = CAST(c_custkey AS VARCHAR)"))
def _(spark, sf):
    return joins.merge_features(
        {"a": user_types(spark, sf), "b": table(spark, sf, "customer").select(
            F.col("c_custkey").cast("string"), "c_acctbal", "c_nationkey")},
        include_column_prefix=False, allow_mismatched_indices=True)


TRAINING = """ts AS (SELECT ft.*, 'biggest' AS response_name, biggest AS response
  FROM ft LEFT JOIN rs ON ft.user_id = rs.user_id UNION ALL
  SELECT ft.*, 'late', late FROM ft LEFT JOIN rs ON ft.user_id = rs.user_id)"""


@query("training_set", with_ctes(USER_TYPES, USER_WEEKDAYS, FEATURES, RESPONSE, TRAINING,
                                 "SELECT * FROM ts"))
def _(spark, sf):
    return joins.training_set(features(spark, sf), response(spark, sf))


@query("single_training_set", with_ctes(
    USER_TYPES, USER_WEEKDAYS, RESPONSE, f"""SELECT ut.*, {', '.join(WEEKDAYS)}, biggest, late
FROM ut LEFT JOIN uw ON ut.user_id = uw.user_id LEFT JOIN rs ON ut.user_id = rs.user_id"""))
def _(spark, sf):
    return joins.single_training_set(features(spark, sf), response(spark, sf))


VARIANCES = " UNION ALL ".join(
    f"SELECT '{c}' AS col_id, var_samp({c}) AS v, sum({c}) AS total FROM ft"
    for c in [f"type_{c}" for c in T_COLS] + [f"day_{c}" for c in WEEKDAYS])


@query("select_features_per_response", with_ctes(
    USER_TYPES, USER_WEEKDAYS, FEATURES, f"vs AS ({VARIANCES})",
    f"""SELECT response_name, col_id, {r('total', 2)} AS total FROM vs,
(VALUES ('biggest'), ('late')) AS n(response_name)
WHERE v >= (SELECT quantile_cont(v, 0.5) FROM vs)"""))
def _(spark, sf):
    training = joins.training_set(features(spark, sf), response(spark, sf))
    chosen = steps.select_features_per_response(training, [{"min_variance": {"quantile": 0.5}}])
    parts = []
    for name, df in chosen.items():
        cols = [c for c in df.columns if c not in ("user_id", "response_name", "response")]
        one = df.agg(*[F.sum(c).alias(c) for c in cols])
        parts.append(one.unpivot([], cols, "col_id", "total")
                     .select(F.lit(name).alias("response_name"), "col_id", "total"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return rounded(out, 2)


@query("annotate", with_ctes(PART_TOTALS, """SELECT pt.*, p_brand, p_type FROM pt
JOIN part ON part = CAST(p_partkey AS VARCHAR)"""))
def _(spark, sf):
    side = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string"), "p_brand", "p_type")
    return joins.annotate(part_totals(spark, sf), side)


@query("shared_rows", with_ctes(PART_TOTALS, """SELECT * FROM pt
WHERE part IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier)"""))
def _(spark, sf):
    """Parts whose number is also a supplier's."""
    left, _ = joins.shared_rows(part_totals(spark, sf), table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string"), "s_acctbal"))
    return left
