"""The tables of the exploratory report, over users by day."""

from __future__ import annotations

from catalog.inputs import (DAYS, PART_TOTALS, TOTALS, USER_DAYS, long_sql, part_totals, user_days,
                            with_ctes)
from catalog.registry import query, r, rounded
from tessella.operators import profile

LONG = [USER_DAYS, long_sql("l", "ud", "user_id", DAYS)]
PT_LONG = [PART_TOTALS, long_sql("l", "pt", "part", TOTALS)]


@query("profile_dimensions", with_ctes(
    USER_DAYS, "SELECT count(*) AS num_rows, CAST(30 AS BIGINT) AS num_cols FROM ud"))
def _(spark, sf):
    return profile.dimensions(user_days(spark, sf))


@query("profile_column_types", with_ctes(PART_TOTALS, """SELECT lower(data_type) AS type, count(*) AS num_cols
FROM (SELECT unnest([typeof(qty), typeof(price), typeof(balance), typeof(full_price)]) AS data_type
  FROM pt LIMIT 4) GROUP BY 1"""))
def _(spark, sf):
    return profile.column_types(part_totals(spark, sf))


def _histogram(x: str, bins: int) -> str:
    return with_ctes(*PT_LONG, f"v AS (SELECT {x} AS x FROM l WHERE value IS NOT NULL)",
                     f"e AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS step FROM v)",
                     f"""SELECT bin, {r('lo + bin * step')} AS low, {r('lo + (bin + 1) * step')} AS high, n
FROM (SELECT CAST(least(floor((x - lo) / step), {bins - 1}) AS INT) AS bin, any_value(lo) AS lo,
  any_value(step) AS step, count(*) AS n FROM v, e GROUP BY 1)""")


@query("profile_histogram", _histogram("value", 50))
def _(spark, sf):
    return rounded(profile.value_histogram(part_totals(spark, sf)))


@query("profile_histogram_log2", _histogram("sign(value) * log2(abs(value) + 1)", 37))
def _(spark, sf):
    return rounded(profile.value_histogram(part_totals(spark, sf), bins=37, log=True))


@query("profile_values", with_ctes(*LONG, f"""SELECT {r('min(value)', 4)} AS min,
  {r('quantile_cont(value, 0.25)', 4)} AS q25, {r('median(value)', 4)} AS median,
  {r('quantile_cont(value, 0.75)', 4)} AS q75, {r('max(value)', 4)} AS max, {r('avg(value)', 4)} AS mean FROM l"""))
def _(spark, sf):
    return rounded(profile.value_summary(user_days(spark, sf)), 4)


SIGNS = {"zero": "value = 0", "positive": "value > 0", "negative": "value < 0",
         "missing": "value IS NULL"}


def _signs(long: list[str]) -> str:
    counts = ", ".join(f"count(*) FILTER ({t}) AS num_{n}, {r(f'count(*) FILTER ({t}) * 100.0 / count(*)')} "
                       f"AS pct_{n}" for n, t in SIGNS.items())
    return with_ctes(*long, f"SELECT {counts} FROM l")


@query("profile_signs", _signs(PT_LONG))
def _(spark, sf):
    return rounded(profile.sign_counts(part_totals(spark, sf)))


@query("profile_missing", _signs(LONG))
def _(spark, sf):
    return rounded(profile.sign_counts(user_days(spark, sf)))


STATS = {"missing": "count(*) - count(value)", "mean": "avg(value)", "median": "median(value)",
         "max": "max(value)", "sd": "stddev_samp(value)"}


def _side(side: str, key: str, make) -> None:
    for stat, expression in STATS.items():
        stats = f"s AS (SELECT {key} AS id, {expression} AS v FROM l GROUP BY 1)"
        value = "v" if stat == "missing" else r("v", 4)

        @query(f"profile_{side}_{stat}", with_ctes(*LONG, stats, f"""SELECT {r('min(v)', 4)} AS min,
  {r('median(v)', 4)} AS median, {r('avg(v)', 4)} AS mean, {r('max(v)', 4)} AS max FROM s"""))
        def _(spark, sf, stat=stat):
            return rounded(profile.profile_summary(make(user_days(spark, sf), stat)), 4)

        for largest in ((True,) if stat == "missing" else (True, False)):
            order = "DESC NULLS LAST" if largest else "ASC NULLS LAST"

            @query(f"profile_{side}_{stat}_{'largest' if largest else 'smallest'}", with_ctes(
                *LONG, stats, f"SELECT id, {value} AS {stat} FROM s ORDER BY v {order}, id LIMIT 10"))
            def _(spark, sf, stat=stat, largest=largest):
                return rounded(profile.profile_top(make(user_days(spark, sf), stat), largest), 4)


_side("row", "row_id", profile.row_profile)
_side("column", "col_id", profile.column_profile)
