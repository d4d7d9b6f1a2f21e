"""Aggregation of rows by id, by named set, by cluster and by mapped id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from tessella.frame import col, id_of, value_columns
from tessella.functions.aggregates import Aggregate, aggregate_by, aggregate_many


def aggregate_duplicate_rows(df: DataFrame, func: str | Aggregate = "median",
                             id_col: str | None = None, **options) -> DataFrame:
    """One row per id; rows without an id are left out."""
    id_col = id_of(df, id_col)
    cols = [c for c in value_columns(df, id_col) if c != options.get("order_col")]
    return aggregate_by(df, [id_col], cols, func, **options)


def aggregate_rows_many(df: DataFrame, funcs: Sequence[str], id_col: str | None = None,
                        **options) -> DataFrame:
    """Several aggregates per id, named ``<column>_<func>``."""
    id_col = id_of(df, id_col)
    return aggregate_many(df, [id_col], value_columns(df, id_col), funcs, **options)


def set_members(sets: DataFrame) -> DataFrame:
    """``(set_name, member)`` pairs, each once. Of sets that share a name the last one counts."""
    if "position" in sets.columns:
        last = W.partitionBy("set_name").orderBy(F.col("position").desc())
        sets = sets.withColumn("_n", F.row_number().over(last)).where("_n = 1")
    return sets.select("set_name", F.explode(F.array_distinct("members")).alias("member"))


def set_apply(df: DataFrame, sets: DataFrame, func: str | Aggregate = "sum",
              id_col: str | None = None, **options) -> DataFrame:
    """Aggregate every column over the member rows of each set.

    Sets overlap, so a row may feed many sets; sets without a member row vanish by the inner join.
    ``sets`` has ``set_name`` and either ``members`` (array) or ``member``.
    """
    id_col = id_of(df, id_col)
    pairs = sets if "member" in sets.columns else set_members(sets)
    joined = (pairs.select("set_name", "member")
              .join(df, F.col("member") == col(id_col)).drop("member", id_col))
    return aggregate_by(joined, ["set_name"], value_columns(df, id_col), func, **options)


def map_members(sets: DataFrame, mapping: DataFrame, from_col: str, to_col: str,
                many: bool = False) -> DataFrame:
    """Translated members, one row each: ``set_name, description, position, member``.

    ``sets`` has ``members`` (array), or one row per ``member`` with its ``position``, which is null where
    the sets have no order. The second form keeps a set of any size out of a single row.
    With ``many`` an id may become several members; otherwise the first line of the mapping counts
    (by ``position`` where the mapping has one, else by target). Unmatched members are dropped.
    """
    if "member" in sets.columns:
        pairs = sets.select("set_name", "description", "position", F.col("member").alias("_member"))
    else:
        pairs = sets.select("set_name", "description", F.posexplode("members").alias("position", "_member"))
    order = ["position"] if "position" in mapping.columns else [col(to_col)]
    source, target = col(from_col).cast("string"), col(to_col).cast("string")
    table = mapping.where(source.isNotNull() & target.isNotNull())
    if many:
        table = table.select(source.alias("_from"), target.alias("member")).distinct()
    else:
        table = (table.groupBy(source.alias("_from"))
                 .agg(F.min(F.struct(*order, target.alias("member"))).alias("_first"))
                 .select("_from", "_first.member"))
    return pairs.join(table, F.col("_member") == F.col("_from")).select(
        "set_name", "description", "position", "member")


def map_sets(sets: DataFrame, mapping: DataFrame, from_col: str, to_col: str,
             many: bool = False) -> DataFrame:
    """Translated sets in their array form, members in their old order.

    A set is one row before and after, so the array is as long as the input allows.
    """
    pairs = map_members(sets, mapping, from_col, to_col, many)
    return (pairs.groupBy("set_name", "description")
            .agg(F.sort_array(F.collect_list(F.struct("position", "member"))).alias("_m"))
            .select("set_name", "description", F.col("_m.member").alias("members")))


def aggregate_sets(df: DataFrame, sets: DataFrame, func: str | Aggregate = "sum",
                   mapping: DataFrame | None = None, from_col: str | None = None,
                   to_col: str | None = None, id_col: str | None = None,
                   **options) -> DataFrame:
    """Named-set aggregation, with the members translated first when a mapping is given."""
    if mapping is not None:
        sets = map_members(sets, mapping, from_col, to_col, many=True).select(
            "set_name", "member").distinct()
    return set_apply(df, sets, func, id_col, **options)


def cluster_apply(df: DataFrame, clusters: DataFrame, func: str | Aggregate,
                  id_col: str | None = None, label: str = "cluster", **options) -> DataFrame:
    """Aggregate every column by cluster; ``clusters`` is ``(id, cluster)``."""
    id_col = id_of(df, id_col)
    labels = clusters.select(col(clusters.columns[0]).alias("_id"), col(label).alias("_label"))
    joined = df.join(labels, col(id_col) == F.col("_id")).drop("_id")
    out = aggregate_by(joined, ["_label"], value_columns(df, id_col), func, **options)
    return out.withColumnRenamed("_label", label)


def last_mapping(mapping: DataFrame, from_col: str, to_col: str) -> DataFrame:
    """One target per source id: the last line wins (by ``position``, else the largest target)."""
    order = ["position"] if "position" in mapping.columns else [col(to_col)]
    last = mapping.where(col(from_col).isNotNull()).groupBy(col(from_col).alias("_from")).agg(
        F.max(F.struct(*order, col(to_col).alias("_to"))).alias("_m"))
    return last.select("_from", F.col("_m._to").alias("_to")).where(F.col("_to").isNotNull())


def map_ids(df: DataFrame, mapping: DataFrame, from_col: str, to_col: str,
            collapse: str | Aggregate = "sum", id_col: str | None = None,
            **options) -> DataFrame:
    """Replace row ids by their target, drop unmapped rows and collapse rows that now coincide."""
    id_col = id_of(df, id_col)
    table = last_mapping(mapping, from_col, to_col)
    joined = df.join(table, col(id_col) == F.col("_from")).select(
        F.col("_to").alias(id_col), *[col(c) for c in value_columns(df, id_col)])
    return aggregate_by(joined, [id_col], value_columns(df, id_col), collapse, **options)
