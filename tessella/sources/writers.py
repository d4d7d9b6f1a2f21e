"""Sinks. Steps stay lazy; only named results are written."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_matrix(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """One columnar table, lz4-compressed."""
    df.write.mode(mode).option("compression", "lz4").parquet(path)
    return path


def write_training_sets(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """One folder per response column, ``response_name=<column>``.

    Tasks write the responses they hold, so a large response is spread over many files.
    """
    df.write.mode(mode).partitionBy("response_name").option("compression", "lz4").parquet(path)
    return path
