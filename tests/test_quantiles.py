import numpy as np
import pandas as pd
import pytest

from tessella.functions.quantiles import average_ranks, quantile_cutoff, quantiles


def frame(spark, values, groups=None):
    data = pd.DataFrame({"g": groups if groups is not None else "all", "v": values})
    return spark.createDataFrame(data).repartition(4), data


@pytest.mark.parametrize("kind", ["uniform", "ties", "hot", "lognormal", "two"])
def test_equal_to_pandas(spark, kind):
    rng = np.random.default_rng(3)
    values = {"uniform": rng.random(6000), "ties": rng.integers(0, 20, 6000).astype(float),
              "hot": np.where(rng.random(6000) < 0.34, 7.5, rng.normal(size=6000) * 10),
              "lognormal": rng.lognormal(0, 4, 6000), "two": np.array([1.0, 4.0])}[kind]
    df, data = frame(spark, values)
    probs = [0.0, 0.013, 0.25, 0.5, 0.77, 1.0]
    # an accuracy far below the row count, so that the brackets do the work
    for refine in (False, True):
        got = quantiles(df, "v", probs, accuracy=300, refine=refine).first()["q"]
        assert np.allclose(got, data["v"].quantile(probs), rtol=1e-12)


def test_groups_of_very_different_size(spark):
    rng = np.random.default_rng(5)
    groups = np.where(rng.random(9000) < 0.4, "hot", rng.integers(0, 50, 9000).astype(str))
    df, data = frame(spark, rng.normal(size=9000), groups)
    want = data.groupby("g")["v"].quantile([0.3, 0.5]).unstack()
    for options in ({}, {"refine": True}):
        found = quantiles(df, "v", [0.3, 0.5], ["g"], accuracy=500, **options)
        got = {r["g"]: r["q"] for r in found.collect()}
        assert set(got) == set(want.index)
        for g, q in got.items():
            assert np.allclose(q, want.loc[g], rtol=1e-12)


def test_missing_and_empty(spark):
    df = spark.createDataFrame([(None,), (2.0,), (4.0,)], "v double")
    assert quantiles(df, "v", [0.5]).first()["q"] == [3.0]
    empty = df.where("v > 100")
    assert empty.select(quantile_cutoff(empty, "v", 0.5).alias("q")).collect() == []
    assert df.select(quantile_cutoff(empty, "v", 0.5).alias("q")).first()["q"] is None


def test_cutoff_has_no_cross_join(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "v double")
    kept = df.where(df.v > quantile_cutoff(df, "v", 0.5))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert kept.count() == 5


def test_average_ranks(spark):
    rng = np.random.default_rng(1)
    df, data = frame(spark, rng.integers(0, 90, 3000).astype(float), rng.choice(list("ab"), 3000))
    got = average_ranks(df, "v", ["g"], partitions=7).toPandas()
    data["rank"] = data.groupby("g")["v"].rank()
    want = data.drop_duplicates()
    merged = want.merge(got, on=["g", "v"], suffixes=("", "_got"))
    assert len(merged) == len(want) == len(got)
    assert np.array_equal(merged["rank"], merged["rank_got"])


@pytest.mark.parametrize("refine", [False, True])
def test_last_task_stays_small(spark, refine):
    from pyspark.sql import functions as F
    df = spark.range(200_000).select(F.rand(1).alias("v"))
    found = quantiles(df, "v", [0.5], accuracy=2000, refine=refine)
    values = sorted(r["v"] for r in df.collect())
    assert found.first()["q"] == [(values[99_999] + values[100_000]) / 2]


def spread_of(df, key):
    """Largest share of a key's rows in one partition."""
    from pyspark.sql import functions as F
    counts = [r["count"] for r in df.where(df.g == key).groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_splits_a_hot_key(spark, how):
    from pyspark.sql import functions as F
    from tessella.functions.splitting import join_split
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled",
                                           "spark.sql.shuffle.partitions")}
    try:
        for key, value in zip(kept, ("-1", "false", "16")):
            spark.conf.set(key, value)
        df = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("g"),
                                        F.col("id").alias("_part"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
        side = spark.createDataFrame([("hot", 1), ("10", 2), ("none", 3)], "g string, v int")
        side = side.where("g <> 'hot'") if how == "left_anti" else side
        found = join_split(df, side, ["g"], how)
        plain = df.join(side, "g", how)
        assert found.columns == plain.columns and found.count() == plain.count()
        assert spread_of(plain, "hot") == 1 and spread_of(found, "hot") < 0.2
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
