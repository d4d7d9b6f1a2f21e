"""Matrices and long tables built from the given tables, as DataFrames and as SQL.

Each function reads whole tables; each SQL constant is the body of a CTE of the same shape. Amounts
are in cents, whole numbers held as doubles, so that sums do not depend on the order of adding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DAYS = [f"d{d:02d}" for d in range(1, 31)]
WEEKDAYS = [f"w{d}" for d in range(1, 8)]
TYPES = ["click", "error", "purchase", "signup", "view"]
MONTHS = [f"m{m:02d}" for m in range(1, 13)]
DIMS = [f"e{i}" for i in range(64)]
LINE_CELLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem as a matrix of four measures."""
    return table(spark, sf, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"),
        "l_quantity", "l_extendedprice", (F.col("l_discount") + 0.0).alias("l_discount"),
        (F.col("l_tax") + 0.0).alias("l_tax"))


LINES = """li AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id,
  l_quantity, l_extendedprice, l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax FROM lineitem)"""


def _spread(at: Column, value: Column, names: list) -> list[Column]:
    return [F.round(F.sum(F.when(at == v, value)) * 100).alias(n) for v, n in names]


def _cases(at: str, value: str, names: list) -> str:
    return ", ".join(
        f"round(sum(CASE WHEN {at} = {v!r} THEN {value} END) * 100) + 0.0 AS {n}" for v, n in names)


def _user_matrix(spark, sf, at: Column, names: list) -> DataFrame:
    events = table(spark, sf, "events")
    return events.groupBy(F.col("user_id").cast("string").alias("user_id")).agg(
        *_spread(at, F.col("value"), names))


_DAY_NAMES = [(d, n) for d, n in enumerate(DAYS, 1)]
_WEEKDAY_NAMES = [(d, n) for d, n in enumerate(WEEKDAYS, 1)]
_TYPE_NAMES = [(t, f"t_{t}") for t in TYPES]
_MONTH_NAMES = [(m, n) for m, n in enumerate(MONTHS, 1)]


def user_days(spark: SparkSession, sf: str) -> DataFrame:
    """Users by day of the month; a day without events is missing."""
    return _user_matrix(spark, sf, F.dayofmonth("ts"), _DAY_NAMES)


USER_DAYS = f"""ud AS (SELECT CAST(user_id AS VARCHAR) AS user_id,
  {_cases("day(ts)", "value", _DAY_NAMES)} FROM events GROUP BY 1)"""


def user_types(spark: SparkSession, sf: str) -> DataFrame:
    return _user_matrix(spark, sf, F.col("event_type"), _TYPE_NAMES)


USER_TYPES = f"""ut AS (SELECT CAST(user_id AS VARCHAR) AS user_id,
  {_cases("event_type", "value", _TYPE_NAMES)} FROM events GROUP BY 1)"""


def user_weekdays(spark: SparkSession, sf: str) -> DataFrame:
    return _user_matrix(spark, sf, F.dayofweek("ts"), _WEEKDAY_NAMES)


USER_WEEKDAYS = f"""uw AS (SELECT CAST(user_id AS VARCHAR) AS user_id,
  {_cases("dayofweek(ts) + 1", "value", _WEEKDAY_NAMES)} FROM events GROUP BY 1)"""


def part_months(spark: SparkSession, sf: str, by: str, withhold: int | None = None) -> DataFrame:
    """Quantity by a part attribute and month of the year.

    lineitem is summed by part and month before it meets the part table. With ``withhold`` the
    cells whose number of lines is a multiple of it are missing.
    """
    sums = (table(spark, sf, "lineitem")
            .groupBy("l_partkey", F.month("l_shipdate").alias("m"))
            .agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n")))
    part = table(spark, sf, "part").select("p_partkey", F.col(by).cast("string").alias(by))
    by_cell = (sums.join(part, sums.l_partkey == part.p_partkey).groupBy(by, "m")
               .agg(F.sum("q").alias("q"), F.sum("n").alias("n")))
    if withhold:
        by_cell = by_cell.where(F.col("n") % withhold != 0)
    return by_cell.groupBy(by).agg(
        *_spread(F.col("m"), F.col("q"), _MONTH_NAMES))


def part_months_sql(name: str, by: str, withhold: int | None = None) -> str:
    kept = f"HAVING count(*) % {withhold} <> 0" if withhold else ""
    return f"""{name}_cells AS (SELECT CAST({by} AS VARCHAR) AS {by}, month(l_shipdate) AS m,
  sum(l_quantity) AS q FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 {kept}),
{name} AS (SELECT {by}, {_cases("m", "q", _MONTH_NAMES)} FROM {name}_cells GROUP BY 1)"""


def embedding_wide(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").cast("string").alias("vec_id"),
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(DIMS)])


EMBEDDINGS = f"""em AS (SELECT CAST(vec_id AS VARCHAR) AS vec_id, {", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS {n}" for i, n in enumerate(DIMS))} FROM embeddings)"""


def part_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Parts by totals over their lines, price in thousands; ``balance`` has negatives and zeros."""
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).when(
        F.col("l_returnflag") == "A", -F.col("l_quantity")).otherwise(0.0)
    return (table(spark, sf, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("part"))
            .agg(F.sum("l_quantity").alias("qty"),
                 F.round(F.sum("l_extendedprice") / 1000).alias("price"),
                 F.sum(returned).alias("balance"),
                 F.count_if(F.col("l_discount") == 0).cast("double").alias("full_price")))


PART_TOTALS = """pt AS (SELECT CAST(l_partkey AS VARCHAR) AS part, sum(l_quantity) AS qty,
  round(sum(l_extendedprice) / 1000) AS price,
  sum(CASE l_returnflag WHEN 'R' THEN l_quantity WHEN 'A' THEN -l_quantity ELSE 0.0 END) + 0.0 AS balance,
  CAST(count(*) FILTER (l_discount = 0) AS DOUBLE) AS full_price FROM lineitem GROUP BY 1)"""
TOTALS = ["qty", "price", "balance", "full_price"]


def part_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping sets of parts: by brand, type and size."""
    part = table(spark, sf, "part")
    names = F.array(F.concat(F.lit("brand "), "p_brand"), F.concat(F.lit("type "), "p_type"),
                    F.concat(F.lit("size "), F.col("p_size").cast("string")))
    return part.select(F.explode(names).alias("set_name"),
                       F.col("p_partkey").cast("string").alias("member"))


PART_SETS = """ps AS (
  SELECT 'brand ' || p_brand AS set_name, CAST(p_partkey AS VARCHAR) AS member FROM part UNION ALL
  SELECT 'type ' || p_type, CAST(p_partkey AS VARCHAR) FROM part UNION ALL
  SELECT 'size ' || p_size, CAST(p_partkey AS VARCHAR) FROM part)"""


def with_ctes(*parts: str) -> str:
    """``WITH a AS (…), b AS (…) <last>``."""
    return "WITH " + ",\n".join(parts[:-1]) + "\n" + parts[-1]


def long_sql(name: str, source: str, id_col: str, cols: list[str]) -> str:
    """CTE with ``(row_id, col_id, value)``, missing cells included."""
    rows = " UNION ALL ".join(
        f"SELECT {id_col} AS row_id, '{c}' AS col_id, {c} AS value FROM {source}" for c in cols)
    return f"{name} AS ({rows})"
