import pytest

from catalog import QUERIES
from tessella.errors import EmptyResultError
from tessella.operators import columns


def test_by_name(numeric):
    assert columns.filter_cols_name_in(numeric, ["c2", "id", "c0"]).columns == ["id", "c2", "c0"]
    with pytest.raises(KeyError):
        columns.filter_cols_name_in(numeric, ["nope"])
    assert columns.filter_cols_name_not_in(numeric, ["c1", "nope"]).columns == ["id", "c0", "c2"]
    with pytest.raises(KeyError):
        columns.filter_cols_name_not_in(numeric, ["nope"], errors="raise")
    assert columns.filter_cols_name_startswith(numeric, "c").columns == ["id"]
    assert columns.filter_cols_name_startswith(numeric, "c", drop=False).columns == numeric.columns
    assert columns.filter_cols_name_endswith(numeric, "1").columns == ["id", "c0", "c2"]


def test_rename(numeric):
    assert columns.rename_cols_replace(numeric, "c", "i.").columns == ["id", "i.0", "i.1", "i.2"]
    with pytest.raises(ValueError):
        columns.rename_cols_replace(numeric.withColumnRenamed("c1", "x0"), "x", "c")
    assert columns.prefix_columns(numeric, "f").columns == ["id", "f_c0", "f_c1", "f_c2"]


def test_names_with_dots_pass_through(numeric):
    dotted = columns.rename_cols_replace(numeric, "c", "a.")
    assert columns.filter_cols_name_in(dotted, ["a.1"]).count() == 4
    assert columns.filter_cols_by_func(dotted, "sum", value=4).columns == ["id", "a.1", "a.2"]


def test_by_statistic(numeric):
    # sums 4, 6, 8
    assert columns.filter_cols_by_func(numeric, "sum", value=0).columns == numeric.columns
    assert columns.filter_cols_by_func(numeric, "sum", value=4).columns == ["id", "c1", "c2"]
    assert columns.filter_cols_by_func(numeric, "sum", quantile=0.5).columns == ["id", "c2"]
    assert columns.filter_cols_by_func(numeric, "median", "ge", value=1.5).columns == ["id", "c1", "c2"]
    with pytest.raises(EmptyResultError):
        columns.filter_cols_by_func(numeric, "sum", value=8)


def test_min_variance_keeps_id_and_response(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 5.0, 0.0, 1.0), ("b", 2.0, 5.0, 9.0, 1.0), ("c", 3.0, 5.0, 3.0, 1.0)],
        "id string, f1 double, f2 double, f3 double, response double")
    assert columns.min_variance(df, value=1.0).columns == ["id", "f1", "f3", "response"]
    assert columns.min_variance(df, quantile=0.9).columns == ["id", "f3", "response"]
    # a value wins over a quantile
    assert columns.min_variance(df, value=0.0, quantile=1.0).columns == df.columns
    with pytest.raises(ValueError):
        columns.min_variance(df)


def test_profiling_drops(missing, spark):
    # 1, 2, 2 of 4 cells missing
    assert columns.drop_missing_cols(missing, 0.25).columns == ["id", "c0"]
    flat = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 3.0)], "id string, x double, y double")
    assert columns.drop_zero_variance_cols(flat).columns == ["id", "y"]
    one = flat.limit(1)
    assert columns.drop_zero_variance_cols(one).columns == ["id"]


def test_no_column_is_left(spark, tmp_path):
    """Every day of the month is missing for most users: no column stays, and there are no cells."""
    spark.sql("""SELECT id AS event_id, make_timestamp(2024, 1, CAST(1 + id AS INT), 0, 0, 0) AS ts, id AS user_id,
      'view' AS event_type, 1.5D AS value FROM range(30)""").write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["drop_missing_cols"](spark, str(tmp_path))
    assert got.columns == ["col_id", "total"]
    assert got.count() == 0
    assert columns.drop_missing_cols(spark.createDataFrame([("a",)], "id string")).columns == ["id"]


def test_informative_columns(spark):
    df = spark.createDataFrame([("a", "x", None, "t1"), ("b", "x", "u", "t2"), ("c", "x", "v", "t3")],
                               "id string, same string, kind string, title string")
    assert columns.informative_columns(df, columns.IDENTIFIER_COLUMNS) == ["kind"]
