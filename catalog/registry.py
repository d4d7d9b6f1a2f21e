"""Named queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is defined twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to the given places, with one kind of zero."""
    return df.select(*[
        (F.round(F.col(f"`{f.name}`"), places) + 0.0).alias(f.name)
        if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`")
        for f in df.schema.fields])


def r(expression: str, places: int = 6) -> str:
    """SQL counterpart of ``rounded``."""
    return f"(round({expression}, {places}) + 0.0)"
