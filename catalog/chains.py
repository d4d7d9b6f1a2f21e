"""Chains of operators, sampling, and tables written and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog.inputs import (MONTHS, PART_TOTALS, TYPES, USER_TYPES, USER_WEEKDAYS, lines,
                            part_months, part_months_sql, part_totals, table, with_ctes)
from catalog.joins import (FEATURES, RESPONSE, TRAINING, features, response)
from catalog.registry import query, r, rounded
from tessella.operators import joins
from tessella.plans import steps
from tessella.runtime import checkpoint_dir
from tessella.sources import readers, sampling, writers

SCREEN_ACTIONS = [
    {"filter_cols_name_in": {"names": ["user_id", "event_type", "value", "weight"]}},
    {"filter_rows_name_not_in": {"names": [7], "errors": "ignore"}},
    {"filter_rows_col_not_na": {"col": "value"}},
    {"filter_rows_col_gt": {"id": "positive", "col": "weight", "value": 0}},
    {"filter_rows_group_size_ge": {"id": "enough", "group": "user_id", "size": 3, "save": True}},
    {"filter_cols_name_not_in": {"names": ["weight"]}},
    {"filter_rows_group_func_ge": {"id": "variable", "group": "user_id", "col": "value",
                                   "func": "mad", "quantile": 0.5}},
    {"pivot_wide": {"id": "screen", "index": None, "columns": "event_type", "values": "value"}},
]


def screen(spark: SparkSession, sf: str) -> DataFrame:
    """The screening chain: users by event type, for users who vary enough."""
    events = table(spark, sf, "events").groupBy("user_id", "event_type").agg(
        F.max("value").alias("value"), F.max("value").alias("weight"))
    data = {"name": "events", "data": events, "actions": SCREEN_ACTIONS}
    return steps.run(spark, [data])["screen"]


@query("screen_chain", f"""WITH e AS (SELECT user_id, event_type, max(value) AS value FROM events
  WHERE user_id <> 7 GROUP BY 1, 2 HAVING max(value) > 0),
k AS (SELECT * FROM e WHERE user_id IN (SELECT user_id FROM e GROUP BY 1 HAVING count(*) >= 3)),
m AS (SELECT user_id, median(value) AS m FROM k GROUP BY 1),
g AS (SELECT k.user_id, median(abs(value - m)) / 0.674489750196082 AS s
  FROM k JOIN m ON k.user_id = m.user_id GROUP BY 1)
SELECT user_id, {", ".join(f"max(CASE WHEN event_type = '{t}' THEN value END) AS {t}" for t in TYPES)}
FROM k WHERE user_id IN (SELECT user_id FROM g WHERE s >= (SELECT quantile_cont(s, 0.5) FROM g))
GROUP BY 1""")
def _(spark, sf):
    return screen(spark, sf)


COUNTS = {"name": "sizes", "actions": [
    {"filter_cols_name_not_in": {"names": ["m12"]}},
    {"filter_rows_var_gt": {"id": "varying", "value": 0}},
    {"group": {"id": "log_cpm", "actions": ["transform_cpm", "transform_log2p"]}},
    {"branch": [{"transform_zscore": {"id": "scaled", "axis": 0}}]},
    {"filter_rows_sum_gt": {"id": "large", "quantile": 0.5}},
]}


def _counts(spark, sf):
    return steps.run(spark, [{**COUNTS, "data": part_months(spark, sf, "p_size")}])


SCALED = MONTHS[:11]
CPM = ", ".join(f"log2({m} / (SELECT sum({m}) FROM sm) * 1e6 + 1) AS {m}" for m in SCALED)


@query("branch_scaled", with_ctes(
    part_months_sql("sm", "p_size"), f"c AS (SELECT p_size, {CPM} FROM sm)",
    "SELECT p_size, " + ", ".join(
        f"{r(f'({m} - (SELECT avg({m}) FROM c)) / (SELECT stddev_pop({m}) FROM c)')} AS {m}"
        for m in SCALED) + " FROM c"))
def _(spark, sf):
    return rounded(_counts(spark, sf)["scaled"])


@query("branch_main", with_ctes(
    part_months_sql("sm", "p_size"), f"c AS (SELECT p_size, {CPM} FROM sm)",
    f"t AS (SELECT *, {' + '.join(f'coalesce({m}, 0)' for m in SCALED)} AS s FROM c)",
    f"""SELECT p_size, {", ".join(f"{r(m)} AS {m}" for m in SCALED)} FROM t
WHERE s > (SELECT quantile_cont(s, 0.5) FROM t)"""))
def _(spark, sf):
    return rounded(_counts(spark, sf)["large"])


# --- sampling: which rows is up to the hash, so SQL checks the size ---

@query("sample_rows", "SELECT CAST(round_even(count(*) * 0.05, 0) AS BIGINT) AS n, "
                      "CAST(round_even(count(*) * 0.05, 0) AS BIGINT) AS ids FROM lineitem")
def _(spark, sf):
    return sampling.sample_rows(lines(spark, sf), 0.05).agg(
        F.count("*").alias("n"), F.count_distinct("row_id").alias("ids"))


@query("sample_columns", "SELECT count(*) AS n, CAST(2 AS BIGINT) AS cols FROM lineitem")
def _(spark, sf):
    part = sampling.sample_columns(lines(spark, sf), 0.5)
    return part.agg(F.count("*").alias("n"),
                    F.max(F.lit(len(part.columns) - 1)).cast("long").alias("cols"))


@query("display_sample", "SELECT least(1000, count(*)) AS n, CAST(2 AS BIGINT) AS cols FROM lineitem")
def _(spark, sf):
    part = sampling.display_sample(lines(spark, sf), columns=2)
    return part.agg(F.count("*").alias("n"),
                    F.max(F.lit(len(part.columns) - 1)).cast("long").alias("cols"))


# --- written to the shared folder and read back ---

def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/tables-{uuid.uuid4().hex}"


TOTAL_SQL = with_ctes(PART_TOTALS, "SELECT part, qty, nullif(balance, 0.0) AS balance FROM pt")


def _totals(spark, sf):
    """Part totals with gaps, so that missing cells pass through the files."""
    return part_totals(spark, sf).select(
        "part", "qty", F.when(F.col("balance") != 0, F.col("balance")).alias("balance"))


def _text_round_trip(name: str, sep: str, **options) -> None:
    @query(name, TOTAL_SQL)
    def _(spark, sf):
        path = _folder(spark) + (".tsv" if sep == "\t" else ".csv")
        (_totals(spark, sf).write.option("header", True).option("sep", sep)
         .option("nullValue", "NA").options(**options).csv(path))
        return readers.load_matrix(spark, path, schema="part string, qty double, balance double")


_text_round_trip("load_csv", ",")
_text_round_trip("load_tsv_gzip", "\t", compression="gzip")


@query("load_parquet", TOTAL_SQL)
def _(spark, sf):
    path = _folder(spark) + ".parquet"
    nan = F.coalesce(F.col("balance"), F.lit(float("nan"))).alias("balance")
    writers.write_matrix(_totals(spark, sf).select("part", "qty", nan), path)
    return readers.load_matrix(spark, path)


@query("load_gmt", """SELECT p_brand AS set_name, 'parts' AS description, count(*) AS n FROM part
GROUP BY 1, 2 HAVING count(*) > 7""")
def _(spark, sf):
    path = _folder(spark) + ".gmt"
    sets = table(spark, sf, "part").groupBy("p_brand").agg(
        F.concat_ws("\t", F.collect_list(F.col("p_partkey").cast("string"))).alias("members"))
    (sets.select(F.concat_ws("\t", "p_brand", F.lit("parts"), "members").alias("value"))
     .write.text(path))
    return readers.load_gmt(spark, path, min_size=7).select(
        "set_name", "description", F.size("members").cast("long").alias("n"))


@query("load_mapping", """SELECT CAST(p_partkey AS VARCHAR) AS "from", p_brand AS "to" FROM part""")
def _(spark, sf):
    path = _folder(spark) + ".tsv"
    (table(spark, sf, "part").select(F.col("p_partkey").alias("from"), F.col("p_brand").alias("to"))
     .write.option("header", True).option("sep", "\t").csv(path))
    return readers.load_mapping(spark, path).select("from", "to")


@query("load_metadata", """SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS DOUBLE) AS p_size,
  CAST(p_retailprice AS DOUBLE) AS p_retailprice FROM part""")
def _(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size",
                                           "p_retailprice", F.lit("same").alias("constant"))
    return readers.load_metadata(part)


@query("write_training_sets", with_ctes(USER_TYPES, USER_WEEKDAYS, FEATURES, RESPONSE, TRAINING,
                                        "SELECT * FROM ts"))
def _(spark, sf):
    path = writers.write_training_sets(
        joins.training_set(features(spark, sf), response(spark, sf)), _folder(spark))
    return spark.read.parquet(path)
