"""Feature merging, training sets and annotation joins. Row ids are unique in a matrix."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from tessella.errors import EmptyResultError
from tessella.frame import col, id_of, value_columns
from tessella.operators.columns import prefix_columns

MISMATCH = "row ids do not match those of the other tables"


def _with_id(df: DataFrame, key: str) -> DataFrame:
    return df.withColumnRenamed(id_of(df), key)


def _checked_join(left: DataFrame, right: DataFrame, key: str,
                  allow_mismatched: bool) -> DataFrame:
    """Left join; when ids must agree, one full join both merges and raises on a stray id."""
    cols = [col(c) for c in [*value_columns(left, key), *value_columns(right, key)]]
    if allow_mismatched:
        return left.join(right, key, "left").select(col(key), *cols)
    other = right.withColumnRenamed(key, "_other")
    joined = left.join(other, col(key) == F.col("_other"), "full")
    stray = col(key).isNull() | F.col("_other").isNull()
    checked = F.when(stray, F.raise_error(F.lit(MISMATCH))).otherwise(col(key))
    return joined.select(checked.cast(left.schema[key].dataType).alias(key), *cols)


def merge_features(features: Mapping[str, DataFrame], include_column_prefix: bool = True,
                   allow_mismatched_indices: bool = False) -> DataFrame:
    """Left-join feature tables on the row id; the first one leads.

    Column names may not overlap. Unless mismatches are allowed, an id that one table lacks is an
    error when the result is computed.
    """
    merged, key = None, None
    for stem, df in features.items():
        key = key or id_of(df)
        df = _with_id(df, key)
        if include_column_prefix:
            df = prefix_columns(df, stem, key)
        if merged is None:
            merged = df
            continue
        shared = set(value_columns(merged, key)) & set(value_columns(df, key))
        if shared:
            raise ValueError(f"column names of {stem} overlap: {sorted(shared)}")
        merged = _checked_join(merged, df, key, allow_mismatched_indices)
    return merged


def ensure_shared_ids(left: DataFrame, right: DataFrame) -> None:
    """Raise when two tables have no row id in common (one job, stops at the first match)."""
    key = id_of(left)
    if left.select(col(key)).join(_with_id(right, key).select(col(key)), key,
                                  "left_semi").isEmpty():
        raise EmptyResultError("no shared row ids")


def training_set(features: Mapping[str, DataFrame], response: DataFrame,
                 include_column_prefix: bool = True, allow_mismatched_indices: bool = False,
                 check_shared: bool = False) -> DataFrame:
    """One training set per response column, as rows of one frame.

    Columns: id, features…, ``response_name``, ``response``. The response is joined once and then
    spread over its columns, so each set keeps all feature rows, also those without a response.
    """
    merged = merge_features(features, include_column_prefix, allow_mismatched_indices)
    key = id_of(merged)
    if check_shared:
        ensure_shared_ids(merged, response)
    targets = value_columns(response)
    packed = _with_id(response, key).select(col(key), F.array(*[
        F.struct(F.lit(c).alias("response_name"), col(c).cast("double").alias("response"))
        for c in targets]).alias("_r"))
    joined = _checked_join(merged, packed, key, allow_mismatched_indices)
    unknown = F.array(*[F.struct(F.lit(c).alias("response_name"),
                                 F.lit(None).cast("double").alias("response")) for c in targets])
    return (joined.withColumn("_r", F.explode(F.coalesce(F.col("_r"), unknown)))
            .select(*[col(c) for c in merged.columns], "_r.response_name", "_r.response"))


def single_training_set(features: Mapping[str, DataFrame], response: DataFrame) -> DataFrame:
    """All features and the whole response table side by side, by left joins."""
    merged = merge_features(features, include_column_prefix=False, allow_mismatched_indices=True)
    return _checked_join(merged, _with_id(response, id_of(merged)), id_of(merged), True)


def annotate(df: DataFrame, annotation: DataFrame, id_col: str | None = None) -> DataFrame:
    """Add the columns of a side table keyed by its first column; unmatched rows are dropped."""
    id_col = id_of(df, id_col)
    side = annotation.withColumnRenamed(annotation.columns[0], id_col)
    return df.join(side, id_col)


def shared_rows(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both matrices limited to the row ids they share."""
    key = id_of(left)
    other = _with_id(right, key)
    return (left.join(other.select(col(key)), key, "left_semi"),
            other.join(left.select(col(key)), key, "left_semi"))
