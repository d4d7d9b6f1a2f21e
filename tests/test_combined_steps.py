"""Row filters combined and filters by biotype as steps of a chain."""

import pytest
from helpers import ids

from tessella.plans.steps import OPERATORS


def test_filters_combine(numeric):
    high = {"filter_rows_col_gt": {"column": "c1", "value": 1.5}}
    low = {"filter_rows_name_in": {"names": ["2", "3"]}}
    assert ids(OPERATORS["filter_and"](numeric, [high, low])) == ["2"]
    assert ids(OPERATORS["filter_or"](numeric, [high, low])) == ["0", "2", "3"]
    assert ids(OPERATORS["filter_and"](numeric, [])) == ["0", "1", "2", "3"]


def test_filters_by_biotype(spark, numeric):
    genes = spark.createDataFrame([("0", "coding"), ("1", "other"), ("2", "coding")], "gene string, biotype string")
    kept = OPERATORS["filter_rows_gene_biotype_in"](numeric, annotation=genes, gene_biotypes=["coding"])
    assert ids(kept) == ["0", "2"]
    rest = OPERATORS["filter_rows_gene_biotype_not_in"](numeric, annotation=genes, gene_biotypes=["coding"])
    assert "0" not in ids(rest) and "1" in ids(rest)


def test_rows_that_share_an_id_are_judged_apart(spark):
    df = spark.createDataFrame([("1", 5, 0), ("1", 0, 5), ("2", 5, 5), (None, 5, 5)], "id string, a int, b int")
    both = [{"filter_rows_col_gt": {"col": "a", "value": 1}}, {"filter_rows_col_gt": {"col": "b", "value": 1}}]
    assert sorted(map(tuple, OPERATORS["filter_and"](df, both).collect()), key=str) == [("2", 5, 5), (None, 5, 5)]
    assert OPERATORS["filter_or"](df, both).count() == 4
    spec = {"filter1": "filter_rows_col_gt", "fargs1": {"col": "a", "value": 1},
            "filter2": "filter_rows_col_gt", "fargs2": {"col": "b", "value": 1}}
    assert OPERATORS["filter_and"](df, **spec).count() == 2
    plan = OPERATORS["filter_and"](df, both)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    nested = [both[0], {"filter_or": {"filters": [both[1], {"filter_rows_name_in": {"names": ["1"]}}]}}]
    assert OPERATORS["filter_and"](df, nested).count() == 3
    with pytest.raises(ValueError):
        OPERATORS["filter_and"](df, [{"transform_log2": {}}])
    with pytest.raises(TypeError):
        OPERATORS["filter_and"](df, filter1="complete_cases", other=1)


def test_every_row_filter_combines(spark, numeric, grouped):
    genes = spark.createDataFrame([("0", "coding"), ("1", "other"), (None, "coding")], "gene string, biotype string")
    for action in ({"filter_rows_sum_gt": {"quantile": 0.3}}, {"filter_rows_var_gt": {"value": 0.1}},
                   {"filter_rows_max_na": {"value": 0}}, {"filter_rows_min_nonzero": {"value": 1}},
                   {"filter_rows_col_not_na": {"col": "c0"}}, {"filter_rows_col_in": {"col": "c0", "values": [1.0]}},
                   {"filter_rows_col_not_in": {"col": "c0", "values": [1.0]}}, {"filter_rows_name_not_in": {"names": ["0"]}},
                   {"filter_rows_name_startswith": {"prefix": "0"}}, {"filter_rows_name_endswith": {"suffix": "0", "drop": False}},
                   "complete_cases", {"filter_rows_gene_biotype_in": {"annotation": genes, "gene_biotypes": ["coding"]}},
                   {"filter_rows_gene_biotype_not_in": {"annotation": genes, "gene_biotypes": ["coding"]}}):
        name, params = (action, {}) if isinstance(action, str) else next(iter(action.items()))
        alone = OPERATORS[name](numeric, **{{"col": "column"}.get(k, k): v for k, v in params.items()})
        assert ids(OPERATORS["filter_and"](numeric, [action])) == ids(alone), name
        assert ids(OPERATORS["filter_or"](numeric, [action, {"filter_rows_name_in": {"names": []}}])) == ids(alone), name
    for action in ({"filter_rows_group_func_ge": {"group": "group", "col": "X", "func": "sum", "value": 8}},
                   {"filter_rows_group_func_le": {"group": "group", "col": "X", "func": "max", "value": 2}},
                   {"filter_rows_group_size_ge": {"group": "group", "size": 3}}):
        (name, params), = action.items()
        alone = OPERATORS[name](grouped, **{{"col": "column"}.get(k, k): v for k, v in params.items()})
        assert ids(OPERATORS["filter_and"](grouped, [action])) == ids(alone), name
    with pytest.raises(KeyError):
        OPERATORS["filter_and"](numeric, [{"filter_rows_name_not_in": {"names": ["9"], "errors": "raise"}}])
