import pytest
from helpers import ids

from tessella.errors import EmptyResultError
from tessella.frame import ensure_not_empty
from tessella.functions.rowwise import row_sum
from tessella.operators import rows


def test_column_cutoffs(numeric):
    assert ids(rows.filter_rows_col_gt(numeric, "c1", value=1.5)) == ["0", "2"]
    assert ids(rows.filter_rows_col_gt(numeric, "c1", quantile=0.5)) == ["0", "2"]
    assert ids(rows.filter_rows_by_col(numeric, "c1", "le", value=1)) == ["1", "3"]


def test_row_sums(numeric):
    assert len(ids(rows.filter_rows_sum_gt(numeric, value=-1))) == 4
    assert ids(rows.filter_rows_sum_gt(numeric, value=0)) == ["0", "1", "2"]
    with pytest.raises(EmptyResultError):
        ensure_not_empty(rows.filter_rows_sum_gt(numeric, value=9), "filter_rows_sum_gt")


def test_row_sum_of_missing_is_zero(missing):
    assert ids(rows.filter_rows_sum_gt(missing, value=-1)) == ["0", "1", "2", "3"]
    assert ids(rows.filter_rows_sum_gt(missing, value=0)) == ["0", "2"]


def test_row_sum_quantile(numeric):
    # sums 6, 3, 9, 0
    assert ids(rows.filter_rows_sum_gt(numeric, quantile=0.5)) == ["0", "2"]
    assert ids(rows.filter_rows_sum_gt(numeric, quantile=0.9)) == ["2"]


def test_row_variance_is_population(numeric, spark):
    assert ids(rows.filter_rows_var_gt(numeric, value=0)) == ["0", "2"]
    two = spark.createDataFrame([("a", 1.0, 2.0)], "id string, x double, y double")
    assert ids(rows.filter_rows_var_gt(two, value=0.24)) == ["a"]
    assert ids(rows.filter_rows_var_gt(two, value=0.25)) == []


def test_missing_counts(missing):
    assert ids(rows.filter_rows_max_na(missing, value=0)) == ["0"]
    assert ids(rows.filter_rows_max_na(missing, value=1)) == ["0", "2", "3"]
    # counts 0, 3, 1, 1
    assert ids(rows.filter_rows_max_na(missing, quantile=0.5)) == ["0", "2", "3"]


def test_missing_counts_as_nonzero(missing):
    assert ids(rows.filter_rows_min_nonzero(missing, value=3)) == ["0", "1", "2"]
    assert ids(rows.filter_rows_min_nonzero(missing, value=1)) == ["0", "1", "2", "3"]


def test_membership_and_missing(missing):
    assert ids(rows.filter_rows_col_not_na(missing, "c1")) == ["0", "3"]
    assert ids(rows.filter_rows_col_in(missing, "c0", [1.0, 2.0])) == ["0", "2"]
    # a missing value is in no list, so the row stays
    assert ids(rows.filter_rows_col_not_in(missing, "c0", [1.0, 2.0])) == ["1", "3"]


def test_names(grouped):
    assert ids(rows.filter_rows_name_in(grouped, ["a", "z"])) == ["a"]
    assert ids(rows.filter_rows_name_not_in(grouped, ["a", "b"])) == list("cdefgh")
    with pytest.raises(KeyError):
        rows.filter_rows_name_not_in(grouped, ["nope"])
    assert len(ids(rows.filter_rows_name_not_in(grouped, ["nope"], errors="ignore"))) == 8
    assert ids(rows.filter_rows_name_startswith(grouped, "a", drop=False)) == ["a"]
    assert ids(rows.filter_rows_name_startswith(grouped, "a")) == list("bcdefgh")
    assert ids(rows.filter_rows_name_endswith(grouped, "h", drop=False)) == ["h"]


def test_group_statistics(grouped):
    kept = rows.filter_rows_by_group_func(grouped, "group", "X", "sum", "gt", value=7)
    assert ids(kept) == ["a", "b", "c", "g"]
    assert kept.columns == grouped.columns
    assert ids(rows.filter_rows_group_size_ge(grouped, "group", 3)) == list("abcdef")
    assert ids(rows.filter_rows_group_func_le(grouped, "group", "X", "max", value=2)) == list("defh")


def test_group_quantile_and_expression(grouped):
    # sums A 8, B 5, C 9, D 0; median 6.5
    kept = rows.filter_rows_group_func_ge(grouped, "group", "X", "sum", quantile=0.5)
    assert ids(kept) == ["a", "b", "c", "g"]
    kept = rows.filter_rows_by_group_func(grouped, "group", "X", "max(x) - min(x)", "ge", value=1)
    assert ids(kept) == list("abcdef")
    with pytest.raises(ValueError):
        rows.filter_rows_by_group_func(grouped, "group", "X", "java_method(x)", value=1)


def test_group_mad(spark):
    df = spark.createDataFrame(
        [(str(i), g, v) for i, (g, v) in enumerate(
            [("p", 1.0), ("p", 2.0), ("p", 6.0), ("q", 1.0), ("q", 1.5), ("q", 2.0),
             ("n", 5.0), ("n", None)])], "id string, g string, x double")
    # scaled MAD: p 1/0.6745, q 0.5/0.6745, n undefined
    kept = rows.filter_rows_group_func_ge(df, "g", "x", "mad", value=1.0)
    assert ids(kept) == ["0", "1", "2"]
    assert ids(rows.filter_rows_group_func_ge(df, "g", "x", "mad", value=0.1)) == list("012345")


def test_missing_group_is_dropped(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("b", "g", 1.0)],
                               "id string, g string, x double")
    assert ids(rows.filter_rows_by_group_func(df, "g", "x", "sum", "gt", value=0)) == ["b"]


def test_combined(numeric):
    both = rows.filter_and(numeric, rows.sum_gt(value=2), rows.col_is("c0", "lt", value=2))
    assert ids(both) == ["0", "1"]
    either = rows.filter_or(numeric, rows.col_is("c0", "eq", value=0), rows.sum_gt(value=8))
    assert ids(either) == ["2", "3"]


def test_groups_combined(grouped):
    big = rows.group_is("group", "X", "sum", "gt", value=7)
    assert ids(rows.filter_and(grouped, big, rows.col_is("Y", "lt", value=5))) == ["a", "c", "g"]
    assert ids(rows.filter_or(grouped, big, rows.col_is("X", "eq", value=0))) == list("abcgh")


def test_annotation(grouped, spark):
    side = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "y")], "key string, kind string")
    assert ids(rows.filter_rows_annotation_in(grouped, side, "key", "kind", ["x", "y"])) == ["a", "b"]
    assert ids(rows.filter_rows_annotation_not_in(grouped, side, "key", "kind", ["x"])) == list("bcdefgh")


def test_variance_and_completeness(missing, numeric):
    assert ids(rows.complete_cases(missing)) == ["0"]
    assert ids(rows.drop_zero_variance_rows(missing)) == ["0", "2"]
    assert ids(rows.drop_zero_variance_rows(numeric)) == ["0", "2"]


def test_cutoff_needs_exactly_one(numeric):
    for arguments in ({}, {"value": 1, "quantile": 0.5}):
        with pytest.raises(ValueError):
            rows.filter_rows_by_func(numeric, row_sum, **arguments)


def test_row_filters_work_on_a_stream(spark, numeric, tmp_path):
    numeric.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(numeric.schema).parquet(str(tmp_path / "in"))
    kept = rows.filter_rows_sum_gt(stream, value=0)
    q = (kept.writeStream.format("memory").queryName("kept_rows")
         .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    q.awaitTermination(60)
    assert ids(spark.table("kept_rows")) == ["0", "1", "2"]
