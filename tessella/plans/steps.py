"""Chains of named operators given as plain lists and dicts.

A dataset is ``{"name", "path" or "data", "actions": [...]}``. An action is an operator name or
``{operator: parameters}``; ``id`` in the parameters names the result. ``{"branch": [...]}`` forks
from the current result and leaves it in place; ``{"group": {"actions": [...]}}`` runs its actions
in a row. ``dataset`` in the parameters refers to another result by name. Everything stays lazy and Catalyst
sees one plan per result, except that ``save: true`` writes a result to the checkpoint folder: worth
it where several later steps, or operators that look at the data first, would compute it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.frame import col, ensure_not_empty
from tessella.operators import (aggregate, cca, cluster, columns, correlate, neighbors, profile,
                                project, rows, shape, transforms)
from tessella.runtime import cut_lineage
from tessella.sources.readers import load_gmt, load_mapping, load_matrix
from tessella.sources.sampling import sample_columns, sample_rows

Operator = Callable[..., DataFrame]


def _gmt_sets(df: DataFrame, gmt: str | None = None, sets: DataFrame | None = None,
              func: str = "sum", min_size: int = 5, **options) -> DataFrame:
    if sets is None:
        sets = load_gmt(df.sparkSession, gmt, min_size)
    return aggregate.aggregate_sets(df, sets, func, **options)


def _map_ids(df: DataFrame, mapping, collapse: str = "sum", **params) -> DataFrame:
    table = load_mapping(df.sparkSession, mapping) if isinstance(mapping, str) else mapping
    return aggregate.map_ids(df, table, params["from"], params["to"], collapse)


def _cross_cor(df: DataFrame, dataset: DataFrame, axis: int = 0, transpose: bool = False,
               method: str = "pearson") -> DataFrame:
    other = shape.transpose_data(dataset) if transpose else dataset
    return correlate.cross_cor_wide(correlate.integrate_cross_cor(df, other, axis, method), axis)


def _by_annotation(filter_rows: Operator) -> Operator:
    """A filter by gene biotypes: the annotation table comes with the step."""
    def run(df: DataFrame, annotation: DataFrame, gene_biotypes: list, key: str | None = None,
            column: str = "biotype") -> DataFrame:
        return filter_rows(df, annotation, key or annotation.columns[0], column, gene_biotypes)
    return run


# row filters as predicates, for filters that combine others: a row passes by its own cells
MASKS: dict[str, Callable[..., rows.Predicate]] = {
    "filter_rows_sum_gt": rows.sum_gt,
    "filter_rows_var_gt": rows.var_gt,
    "row_var_above": rows.var_gt,
    "filter_rows_col_gt": lambda column, value=None, quantile=None: rows.col_is(column, "gt", value, quantile),
    "filter_rows_max_na": rows.max_na,
    "filter_rows_min_nonzero": rows.min_nonzero,
    "filter_rows_col_not_na": rows.col_not_na,
    "filter_rows_col_in": rows.col_in,
    "filter_rows_col_not_in": rows.col_not_in,
    "filter_rows_name_in": rows.name_in,
    "filter_rows_name_not_in": rows.name_not_in,
    "filter_rows_name_startswith": rows.name_startswith,
    "filter_rows_name_endswith": rows.name_endswith,
    "filter_rows_by_group_func": rows.group_is,
    "filter_rows_group_func_ge": lambda group, column, func, value=None, quantile=None, **options: rows.group_is(
        group, column, func, "ge", value, quantile, **options),
    "filter_rows_group_func_le": lambda group, column, func, value=None, quantile=None, **options: rows.group_is(
        group, column, func, "le", value, quantile, **options),
    "filter_rows_group_size_ge": lambda group, size: rows.group_is(group, group, "size", "ge", size),
    "filter_rows_gene_biotype_in": lambda annotation, gene_biotypes, key=None, column="biotype": rows.annotation_in(
        annotation, key or annotation.columns[0], column, gene_biotypes),
    "filter_rows_gene_biotype_not_in": lambda annotation, gene_biotypes, key=None, column="biotype": rows.annotation_not_in(
        annotation, key or annotation.columns[0], column, gene_biotypes),
    "complete_cases": rows.complete,
    "filter_and": lambda filters=None, **spec: _mask_of(rows.all_of, filters, spec),
    "filter_or": lambda filters=None, **spec: _mask_of(rows.any_of, filters, spec),
}


def _mask_of(combine: Callable[..., rows.Predicate], filters: list | None, spec: dict) -> rows.Predicate:
    """The predicate of a combined filter: a list of ``{name: parameters}``, or two filters by name as
    ``filter1, filter2`` with their parameters ``fargs1, fargs2``."""
    if filters is None:
        numbers = sorted(int(k[6:]) for k in spec if k.startswith("filter"))
        filters = [{spec.pop(f"filter{n}"): spec.pop(f"fargs{n}", None)} for n in numbers]
        if spec:
            raise TypeError(f"unexpected parameters: {sorted(spec)}")
    made = []
    for action in filters:
        name, params = _parse(action)
        if name not in MASKS:
            raise ValueError(f"{name!r} can't be combined: it doesn't judge rows one by one")
        made.append(MASKS[name](**_arguments(params)))
    return combine(*made)


def _combined(name: str) -> Operator:
    """Rows that pass all (or any) of several row filters, each judged on the same input.

    The filters are predicates on the row, so rows that share an id are told apart, and the input is
    read once. Without any filter all rows stay.
    """
    def run(df: DataFrame, filters: list[dict] | None = None, **spec) -> DataFrame:
        return df.where(MASKS[name](filters, **spec)(df)) if filters or spec else df
    return run


OPERATORS: dict[str, Operator] = {
    **{f.__name__: f for f in (
        columns.filter_cols_name_in, columns.filter_cols_name_not_in,
        columns.filter_cols_name_startswith, columns.filter_cols_name_endswith,
        columns.filter_cols_by_func, columns.rename_cols_replace, columns.min_variance,
        rows.filter_rows_sum_gt, rows.filter_rows_var_gt, rows.filter_rows_col_gt,
        rows.filter_rows_max_na, rows.filter_rows_min_nonzero, rows.filter_rows_col_not_na,
        rows.filter_rows_col_in, rows.filter_rows_col_not_in, rows.filter_rows_name_in,
        rows.filter_rows_name_not_in, rows.filter_rows_name_startswith,
        rows.filter_rows_name_endswith, rows.filter_rows_group_func_ge,
        rows.filter_rows_group_func_le, rows.filter_rows_group_size_ge,
        rows.filter_rows_annotation_in, rows.filter_rows_annotation_not_in,
        correlate.filter_rows_max_correlation, transforms.transform_cpm,
        transforms.transform_log2, transforms.transform_log2p, transforms.transform_zscore,
        transforms.transform_signed_log2, shape.transpose_data, shape.pivot_wide,
        aggregate.aggregate_duplicate_rows, project.project_pca, neighbors.impute_knn,
        cluster.cluster_hclust)},
    "exclude_columns": lambda df, columns_to_exclude: columns.filter_cols_name_not_in(
        df, columns_to_exclude),
    "row_var_above": rows.filter_rows_var_gt,
    "aggregate_gene_sets": _gmt_sets,
    "map_gene_ids": _map_ids,
    "integrate_cross_cor": _cross_cor,
    "aggregate": lambda df, funcs: aggregate.aggregate_rows_many(df, funcs),
    "filter_rows_by_group_func": rows.filter_rows_by_group_func,
    "filter_rows_gene_biotype_in": _by_annotation(rows.filter_rows_annotation_in),
    "filter_rows_gene_biotype_not_in": _by_annotation(rows.filter_rows_annotation_not_in),
    "filter_and": _combined("filter_and"),
    "filter_or": _combined("filter_or"),
    "complete_cases": rows.complete_cases,
    "knn_graph": neighbors.knn_graph,
    "integrate_cca": lambda df, dataset, **options: cca.integrate_cca(df, dataset, **options),
}

# parameter names of a spec that differ from the argument names (fixed values)
ARGUMENTS = {"col": "column"}


def register_operator(name: str, fn: Operator, mask: Callable[..., rows.Predicate] | None = None) -> None:
    """Add an operator; a row filter may come with a ``mask``, the same parameters to a predicate."""
    OPERATORS[name] = fn
    if mask is not None:
        MASKS[name] = mask


def _arguments(params: dict) -> dict:
    return {ARGUMENTS.get(k, k): v for k, v in params.items()}


def _parse(action) -> tuple[str, dict | list]:
    if isinstance(action, str):
        return action, {}
    (name, params), = action.items()
    return name, params if params is not None else {}


class _Run:
    def __init__(self, spark: SparkSession, check_empty: bool, persist_forks: bool) -> None:
        self.spark = spark
        self.check_empty = check_empty
        self.persist_forks = persist_forks
        self.results = profile.Tables()

    def name(self, wanted: str, given: bool) -> str:
        if wanted not in self.results:
            return wanted
        if given:
            raise ValueError(f"id {wanted!r} is used twice")
        n = 2
        while f"{wanted}_{n}" in self.results:
            n += 1
        return f"{wanted}_{n}"

    def keep(self, step: str, df: DataFrame, reports: list[str]) -> None:
        self.results[step] = df
        for report in reports:
            if report != "general_eda":
                raise ValueError(f"unknown report {report!r}")
            self.results.add(f"{step}/profile/", profile.profile(df))

    def apply(self, name: str, params: dict, df: DataFrame) -> DataFrame:
        if name not in OPERATORS:
            raise ValueError(f"unknown operator {name!r}")
        args = {k: v for k, v in _arguments(params).items()
                if k not in ("id", "reports", "save", "filename", "inline", "local")}
        if isinstance(args.get("dataset"), str):
            args["dataset"] = self.results[args["dataset"]]
        if name == "pivot_wide" and "index" in args and args["index"] is None:
            del args["index"]
        return OPERATORS[name](df, **args)

    def chain(self, dataset: str, actions: list, df: DataFrame) -> DataFrame:
        for action in actions:
            name, params = _parse(action)
            if name == "branch":
                if self.persist_forks and df.storageLevel == StorageLevel.NONE:
                    df = df.persist(StorageLevel.MEMORY_AND_DISK)
                self.chain(dataset, params, df)
                continue
            if name == "input":
                self.keep(dataset, df, params.get("reports", []))
                continue
            if name == "group":
                for inner in params["actions"]:
                    inner_name, inner_params = _parse(inner)
                    df = self.apply(inner_name, inner_params, df)
            else:
                df = self.apply(name, params, df)
            if self.check_empty:
                ensure_not_empty(df, name)
            if params.get("save"):
                df = cut_lineage(df)
            step = self.name(params.get("id", f"{dataset}_{name}"), "id" in params)
            self.keep(step, df, params.get("reports", []))
        return df


def _refers_to(actions: list) -> set[str]:
    names: set[str] = set()
    for action in actions:
        name, params = _parse(action)
        if name == "branch":
            names |= _refers_to(params)
        elif name == "group":
            names |= _refers_to(params["actions"])
        elif isinstance(params.get("dataset"), str):
            names.add(params["dataset"])
    return names


def _makes(dataset: dict) -> set[str]:
    def ids(actions):
        for action in actions:
            name, params = _parse(action)
            if name == "branch":
                yield from ids(params)
            elif "id" in params:
                yield params["id"]
    return {dataset["name"], *ids(dataset.get("actions", []))}


def run(spark: SparkSession, datasets: list[dict], check_empty: bool = False,
        persist_forks: bool = False, sample_row_frac: float | None = None,
        sample_col_frac: float | None = None, random_seed: int = 1) -> dict[str, DataFrame]:
    """All named results of the given datasets.

    A dataset that another one refers to is built first. ``check_empty`` raises as soon as a step
    leaves nothing, at the price of a small job per step. The sampling fractions are for
    development on a part of the rows and columns.
    """
    state = _Run(spark, check_empty, persist_forks)
    waiting = list(datasets)
    while waiting:
        open_ids = {d["name"]: _makes(d) for d in waiting}
        ready = [d for d in waiting if not any(
            _refers_to(d.get("actions", [])) & ids for n, ids in open_ids.items()
            if n != d["name"])]
        if not ready:
            raise ValueError("datasets refer to each other in a circle")
        for dataset in ready:
            waiting.remove(dataset)
            df = dataset.get("data")
            if df is None:
                df = load_matrix(spark, dataset["path"], **{
                    k: dataset[k] for k in ("index_col", "sep", "encoding") if k in dataset})
            if sample_row_frac is not None:
                df = sample_rows(df, sample_row_frac, seed=random_seed)
            if sample_col_frac is not None:
                df = sample_columns(df, sample_col_frac, seed=random_seed)
            state.keep(dataset["name"], df, [])
            last = state.chain(dataset["name"], dataset.get("actions", []), df)
            state.results[f"{dataset['name']}/final"] = last
    return state.results


def select_features(training: DataFrame, methods: list, id_col: str | None = None) -> DataFrame:
    """Feature selection steps in order, each on the result of the one before."""
    for method in methods:
        name, params = _parse(method)
        training = OPERATORS[name](training, id_col=id_col, **params)
    return training


def select_features_per_response(training: DataFrame, methods: list,
                                 id_col: str | None = None) -> dict[str, DataFrame]:
    """The same for each training set of a frame with ``response_name``, by response."""
    names = [r[0] for r in training.select("response_name").distinct()
             .orderBy("response_name").collect()]
    return {n: select_features(training.where(F.col("response_name") == n), methods, id_col)
            for n in names}


def integrate(results: dict[str, DataFrame], entries: list[dict]) -> dict[str, DataFrame]:
    """Integration entries over named results: type ``cca`` or ``cross_cor``."""
    out = {}
    for entry in entries:
        (kind, params), = entry.items()
        x, y = (results[name] for name in params["datasets"])
        options = {k: v for k, v in params.items() if k not in ("datasets", "id", "method")}
        name = params.get("id", f"{kind}_{'_'.join(params['datasets'])}")
        if kind == "cca":
            out[name] = cca.integrate_cca(x, y, **options)
        elif kind == "cross_cor":
            out[name] = correlate.integrate_cross_cor(
                x, y, method=params.get("method", "pearson"), **options)
        else:
            raise ValueError(f"unknown integration {kind!r}")
    return out
