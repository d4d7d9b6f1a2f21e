import numpy as np
import pandas as pd
import pytest
from helpers import matrix, to_pandas
from pyspark.sql import functions as F

from catalog import QUERIES
from tessella.functions import aggregates
from tessella.functions.aggregates import aggregate_by, register_agg
from tessella.operators import aggregate

PANDAS = {
    "sum": "sum", "min": "min", "max": "max", "mean": "mean", "median": "median", "var": "var",
    "std": "std",
    "num_zero": lambda x: (x == 0).sum(), "num_nonzero": lambda x: (x != 0).sum(),
    "num_positive": lambda x: (x > 0).sum(), "num_negative": lambda x: (x < 0).sum(),
    "ratio_zero": lambda x: (x == 0).mean(), "ratio_nonzero": lambda x: (x != 0).mean(),
    "ratio_positive": lambda x: (x > 0).mean(), "ratio_negative": lambda x: (x < 0).mean(),
    "sum_abs": lambda x: x.abs().sum(skipna=False),
}


@pytest.fixture(scope="module")
def set_matrix(spark):
    return spark.createDataFrame([("a", 1, 2, 3), ("b", 5, 10, 15), ("c", 2, 0, 0)],
                                 "id string, c0 long, c1 long, c2 long")


@pytest.fixture(scope="module")
def sets(spark):
    return spark.createDataFrame([("x", ["a", "c", "d"]), ("y", ["a", "b", "c"]),
                                  ("z", ["d", "e", "f"])],
                                 "set_name string, members array<string>")


@pytest.mark.parametrize("func", sorted(PANDAS))
def test_sets(set_matrix, sets, func):
    got = to_pandas(aggregate.set_apply(set_matrix, sets, func)).astype(float)
    values = to_pandas(set_matrix)
    want = pd.DataFrame({s: values.loc[m].agg(PANDAS[func])
                         for s, m in (("x", ["a", "c"]), ("y", ["a", "b", "c"]))}).T
    # a set without a member row is gone
    assert list(got.index) == ["x", "y"]
    assert np.allclose(got, want.astype(float), equal_nan=True)


def test_last_set_of_a_name_counts(set_matrix, spark):
    twice = spark.createDataFrame([("x", ["a"], 0), ("x", ["b", "b"], 1)],
                                  "set_name string, members array<string>, position int")
    assert aggregate.set_apply(set_matrix, twice, "sum").first()["c0"] == 5


@pytest.mark.parametrize("func", ["sum", "prod", "min", "max", "mean", "median", "var", "std",
                                  "sem", "count", "size", "nunique", "skew", "kurt"])
def test_duplicate_rows_like_pandas(spark, func):
    rng = np.random.default_rng(7)
    data = pd.DataFrame({"id": rng.choice(list("abcdefgh"), 60), "x": rng.normal(size=60),
                         "y": rng.integers(0, 4, 60).astype(float)})
    data.loc[len(data)] = ["only", 1.5, 2.0]
    data.loc[rng.random(61) < 0.1, "x"] = np.nan
    df = spark.createDataFrame([(i, None if np.isnan(x) else x, y) for i, x, y in
                                data.itertuples(index=False)], "id string, x double, y double")
    got = to_pandas(aggregate.aggregate_duplicate_rows(df, func)).astype(float)
    grouped = data.groupby("id")
    if func == "size":
        want = pd.DataFrame({c: grouped.size() for c in "xy"})
    elif func in ("skew", "kurt"):
        want = grouped.agg(getattr(pd.Series, func))
    else:
        want = getattr(grouped, func)()
    assert np.allclose(got, want.sort_index().astype(float), equal_nan=True, rtol=1e-9)


def test_missing_id_is_dropped_and_median_is_default(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, 9.0)], "id string, x double")
    assert [tuple(r) for r in aggregate.aggregate_duplicate_rows(df).collect()] == [("a", 2.5)]


def test_hot_groups_agree_with_one_pass(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"id": np.where(rng.random(4000) < 0.35, "hot", rng.integers(0, 300, 4000).astype(str)),
                         "x": rng.normal(size=4000), "y": rng.integers(0, 5, 4000).astype(float)})
    df = spark.createDataFrame(data)
    assert aggregates.hot_groups(df, ["id"], 10_000) is None
    assert [r[0] for r in aggregates.hot_groups(df, ["id"], 500).collect()] == ["hot"]
    for func in ("median", "mad_median"):
        plain = to_pandas(aggregate_by(df, ["id"], ["x", "y"], func))
        split = to_pandas(aggregate_by(df, ["id"], ["x", "y"], func, hot_rows=500))
        assert np.allclose(plain, split, rtol=1e-12, equal_nan=True)
    want = data.groupby("id")[["x", "y"]].quantile(0.9)
    got = to_pandas(aggregate_by(df, ["id"], ["x", "y"], "quantile", prob=0.9, hot_rows=500))
    assert np.allclose(got, want.sort_index())


def test_first_and_last_need_an_order(spark):
    df = spark.createDataFrame([("a", 3.0, 2), ("a", None, 1), ("a", 5.0, 3)],
                               "id string, x double, at int")
    assert aggregate.aggregate_duplicate_rows(df, "first", order_col="at").first()["x"] == 3.0
    assert aggregate.aggregate_duplicate_rows(df, "last", order_col="at").first()["x"] == 5.0
    with pytest.raises(ValueError):
        aggregate.aggregate_duplicate_rows(df, "first")


def test_functions_by_name_and_by_value(set_matrix, spark):
    with pytest.raises(ValueError):
        aggregate_by(set_matrix, ["id"], ["c0"], "cumsum")
    register_agg("spread", lambda x: F.max(x) - F.min(x))
    one = set_matrix.withColumn("id", F.lit("all"))
    assert aggregate.aggregate_duplicate_rows(one, "spread").first()["c1"] == 10

    @F.pandas_udf("double")
    def largest_gap(v: pd.Series) -> float:
        return float(np.diff(np.sort(v)).max())

    assert aggregate.aggregate_duplicate_rows(one, largest_gap).first()["c2"] == 12.0


def test_several_functions(set_matrix):
    one = set_matrix.withColumn("id", F.lit("all"))
    got = aggregate.aggregate_rows_many(one, ["sum", "median"])
    assert got.columns == ["id", "c0_sum", "c0_median", "c1_sum", "c1_median", "c2_sum", "c2_median"]
    assert got.first()["c0_median"] == 2.0 and got.first()["c1_sum"] == 12


def test_cluster_apply(spark):
    df, data = matrix(spark, np.random.default_rng(0).integers(-100, 100, (10, 5)))
    labels = [f"cluster_{i % 3}" for i in range(10)]
    clusters = spark.createDataFrame(list(zip(data.index, labels)), "id string, cluster string")
    for func in ("sum", "min", "num_positive"):
        got = to_pandas(aggregate.cluster_apply(df, clusters, func))
        assert np.allclose(got, data.groupby(labels).agg(PANDAS[func]))


def test_map_ids_last_mapping_wins_and_collapses(set_matrix, spark):
    mapping = spark.createDataFrame(
        [("a", "old", 0), ("a", "P", 1), ("b", "P", 2), ("c", None, 3)],
        "`from` string, `to` string, position int")
    got = aggregate.map_ids(set_matrix, mapping, "from", "to")
    assert [tuple(r) for r in got.collect()] == [("P", 6, 12, 18)]


def test_set_mapping(spark):
    sets = spark.createDataFrame([("s", "d", ["1", "2", "9"])],
                                 "set_name string, description string, members array<string>")
    mapping = spark.createDataFrame([("1", "b", 0), ("1", "a", 1), ("2", "c", 2)],
                                    "k string, t string, position int")
    first = aggregate.map_sets(sets, mapping, "k", "t").first()
    assert first["members"] == ["b", "c"]
    every = aggregate.map_sets(sets, mapping, "k", "t", many=True).first()
    assert every["members"] == ["a", "b", "c"]


def test_sets_of_one_row_per_member(spark, tmp_path):
    """Sets without an array: repeated members stay, and no step of the query gathers a set in one row."""
    sets = spark.createDataFrame([("s", "1"), ("s", "2"), ("s", "2"), ("t", None), ("t", "3")], "set_name string, member string")
    mapping = spark.createDataFrame([("1", "b"), ("2", "c"), ("2", "d"), ("2", "d")], "k string, t string")
    got = aggregate.map_members(sets.withColumns({"description": F.lit(""), "position": F.lit(None).cast("int")}),
                                mapping, "k", "t", many=True)
    assert got.columns == ["set_name", "description", "position", "member"]
    assert sorted((r["set_name"], r["member"]) for r in got.collect()) == [
        ("s", "b"), ("s", "c"), ("s", "c"), ("s", "d"), ("s", "d")]
    spark.sql("""SELECT id AS p_partkey, 'b' AS p_brand, concat('t', id % 2) AS p_type, 3 AS p_size FROM range(6)
              """).write.parquet(f"{tmp_path}/part.parquet")
    spark.sql("SELECT id % 4 AS l_partkey, id % 3 AS l_suppkey FROM range(24)").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = QUERIES["map_sets_to_many"](spark, str(tmp_path))
    assert "collect_list" not in found._jdf.queryExecution().toString()
    assert {(r["set_name"], r["member"]): r["n"] for r in found.collect()} == {
        (s, m): n for s, n in [("brand b", 4), ("type t0", 2), ("type t1", 2), ("size 3", 4)] for m in "012"}


@pytest.mark.parametrize("func", ["median", "quantile", "mad", "mad_median"])
def test_one_group_with_most_rows(spark, func):
    """90 % of the rows in one group, well above the limit of one pass."""
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"g": np.where(rng.random(6000) < 0.9, "hot", rng.choice(["a", "b", "c"], 6000)),
                         "v": rng.lognormal(0, 3, 6000), "w": rng.integers(0, 9, 6000).astype(float)})
    data.loc[(data.index % 50 == 0) & (data.g == "a"), "w"] = np.nan
    rows = [(g, v, None if np.isnan(w) else w) for g, v, w in data.itertuples(index=False)]
    df = spark.createDataFrame(rows, "g string, v double, w double").repartition(6)
    got = aggregates.aggregate_by(df, ["g"], ["v", "w"], func, prob=0.3, hot_rows=1000).toPandas().set_index("g").sort_index()
    own = data.groupby("g")
    want = {"median": lambda: own.median(), "quantile": lambda: own.quantile(0.3),
            "mad": lambda: own.agg(lambda x: (x - x.mean()).abs().mean()),
            "mad_median": lambda: own.agg(lambda x: np.nan if x.isna().any() else (x - x.median()).abs().median() / aggregates.NORMAL_MAD_SCALE)}[func]()
    assert np.allclose(got.astype(float), want.sort_index(), rtol=1e-9, equal_nan=True)
