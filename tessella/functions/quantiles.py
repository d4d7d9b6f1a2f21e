"""Exact quantiles and ranks that never gather a whole group in one task.

A sketch per key meets the rows of the key in many parts (``join_split``), parts count by themselves and
the counts are added up, so a key with most of the rows costs no task more than others.

``percentile`` keeps every distinct value of a group in one buffer, which fails for a group that
holds a large part of the data. ``quantiles`` brackets each wanted rank with a bounded sketch,
counts what lies outside the brackets and keeps only the distinct values inside them. The rank is
then found among those few, so the answer is exact and the last task small. Should a bracket miss
its rank, the query fails; it never answers wrongly.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.frame import col
from tessella.functions.splitting import join_split
from tessella.runtime import cut_lineage

SKETCH_ACCURACY = 20_000
# about 8e9 narrow rows; beyond, brackets are narrowed by a second sketch
REFINE_BYTES = 2**37
REFINE_STEPS = 500


def quantiles(df: DataFrame, value: str | Column, probs: Sequence[float],
              keys: Sequence[str] = (), accuracy: int = SKETCH_ACCURACY, nth: bool = False,
              refine: bool | None = None) -> DataFrame:
    """Exact quantiles per key: ``keys…, q array<double>`` in the order of ``probs``.

    Linear interpolation between the two neighbouring ranks, missing values skipped. With ``nth``
    the value of rank ``round(prob * n)`` is returned instead. Groups without values vanish.
    There should be few keys beside the rows. ``refine`` (by default from the estimated size) takes one more pass and leaves a few
    millionths of the rows for the last task instead of a few ten-thousandths.
    """
    keys, probs = list(keys), [float(p) for p in probs]
    kcols = [col(k) for k in keys]
    v = (col(value) if isinstance(value, str) else value).cast("double")
    # missing values stay in and count for nothing: a filter would compute the value twice
    present = df.select(*kcols, v.alias("_v"))
    if keys:
        present = present.dropna(subset=keys)
    if refine is None:
        refine = _estimated_bytes(present) > REFINE_BYTES

    margin = 3.0 / accuracy
    edges = [max(0.0, p - margin) for p in probs] + [min(1.0, p + margin) for p in probs]
    sketch = present.groupBy(*kcols).agg(
        F.struct(F.count("_v").alias("n"),
                 F.percentile_approx("_v", edges, accuracy).alias("edge")).alias("_s"))
    marked = _attach(present, sketch, keys)
    if refine:
        narrow = _narrowed(marked, kcols, probs, nth)
        marked = _attach(present, narrow, keys)

    n, x = F.col("_s.n"), F.col("_v")
    low, high = _edges(len(probs))
    # below this many values a sketch edge may miss the rank by one, and all values fit anyway
    small = n <= accuracy
    inside = small | reduce(or_, [x.between(a, b) for a, b in zip(low, high)])
    segment = F.when(small, F.lit(0)).otherwise(
        reduce(add, [(x > b).cast("int") for b in high]))
    counted = (marked
               .select(*kcols, n.alias("_n"), segment.alias("_seg"), F.when(inside, x).alias("_x"), x)
               .groupBy(*kcols, "_n", "_seg", "_x").agg(F.count("_v").alias("_c")))
    order = (W.partitionBy(*kcols).orderBy("_seg", F.col("_x").asc_nulls_first())
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    ranked = counted.withColumn("_cum", F.sum("_c").over(order)).where("_n > 0")
    return ranked.groupBy(*kcols).agg(F.array(*[_pick(p, nth) for p in probs]).alias("q"))


def _estimated_bytes(df: DataFrame) -> int:
    """Spark's own size estimate; no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def _attach(df: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    if not keys:
        return df.withColumn("_s", stats.scalar())
    return join_split(df, stats, keys)


def _edges(probs: int) -> tuple[list[Column], list[Column]]:
    edge = F.col("_s.edge")
    return [edge[i] for i in range(probs)], [edge[probs + i] for i in range(probs)]


def _narrowed(marked: DataFrame, kcols: list[Column], probs: list[float],
              nth: bool) -> DataFrame:
    """Narrower edges, from a second sketch of the values inside each bracket."""
    x, (low, high) = F.col("_v"), _edges(len(probs))
    steps = [i / REFINE_STEPS for i in range(REFINE_STEPS + 1)]
    parts = []
    for i in range(len(probs)):
        within = F.when(x.between(low[i], high[i]), x)
        parts.append(F.struct(F.count_if(x < low[i]).alias("below"), F.count(within).alias("n"),
                              F.percentile_approx(within, steps, SKETCH_ACCURACY).alias("at"))
                     .alias(f"p{i}"))
    found = marked.groupBy(*kcols).agg(F.max("_s.n").alias("n"), *parts)
    lows, highs = [], []
    for i, p in enumerate(probs):
        part = F.col(f"p{i}")
        rank = _rank(F.col("n"), p, nth) - part["below"]
        # two ranks and two steps to spare on either side
        lows.append(_step(part, rank - 2, -2))
        highs.append(_step(part, rank + 3, 3))
    return found.select(*kcols, F.struct(F.col("n"), F.array(*lows, *highs).alias("edge"))
                        .alias("_s"))


def _step(part: Column, rank: Column, more: int) -> Column:
    at = F.floor(F.try_divide(rank, part["n"]) * REFINE_STEPS).cast("int") + more
    return F.get(part["at"], F.greatest(F.least(at, F.lit(REFINE_STEPS)), F.lit(0)))


def _rank(rows: Column, p: float, nth: bool) -> Column:
    """Wanted rank, counted from zero."""
    if nth:
        return F.greatest(F.bround(rows * F.lit(p)) - 1, F.lit(0))
    return (rows - 1) * F.lit(p)


def _pick(p: float, nth: bool) -> Column:
    at = _rank(F.col("_n"), p, nth)
    if nth:
        return _value_at(at)
    lower, upper = _value_at(F.floor(at)), _value_at(F.ceil(at))
    weight = F.max(at - F.floor(at))
    return F.when(lower == upper, lower).otherwise(lower + (upper - lower) * weight)


def _value_at(index: Column) -> Column:
    first = F.min(F.when(F.col("_cum") > index, F.struct("_cum", "_x")))
    return F.when(first.isNotNull() & first["_x"].isNull(),
                  F.raise_error(F.lit("quantile bracket missed its rank; change the accuracy"))
                  .cast("double")).otherwise(first["_x"])


def quantile_cutoff(df: DataFrame, value: str | Column, prob: float) -> Column:
    """One quantile of one column as a scalar subquery: lazy, and no join."""
    return quantiles(df, value, [prob]).select(F.col("q")[0].alias("q")).scalar()


def cutoff(df: DataFrame, stat: str | Column, value: float | None,
           quantile: float | None) -> Column:
    """The cutoff a filter compares with: a given value or a quantile of ``stat``."""
    if (value is None) == (quantile is None):
        raise ValueError("give either value or quantile")
    if quantile is None:
        return F.lit(value)
    return quantile_cutoff(df, stat, quantile)


def average_ranks(df: DataFrame, value: str, keys: Sequence[str] = (),
                  weight: str | None = None, partitions: int | None = None) -> DataFrame:
    """Rank of each distinct value within its keys, ties sharing their mean rank.

    ``weight`` says how many rows a row stands for. Returns ``keys…, value, rank``. Distinct values are counted first, then range-partitioned so
    that a large group is spread over many tasks; the part numbers are written to the checkpoint
    folder, because offsets and ranks have to agree on them even after a lost executor.
    """
    keys = list(keys)
    cols = [col(k) for k in keys]
    rows = F.count(F.lit(1)) if weight is None else F.sum(col(weight))
    counted = (df.where(col(value).isNotNull())
               .groupBy(*cols, col(value)).agg(rows.alias("_c")))
    spread = [*cols, col(value)]
    ranged = (counted.repartitionByRange(partitions, *spread) if partitions
              else counted.repartitionByRange(*spread))
    parts = cut_lineage(ranged.withColumn("_part", F.spark_partition_id()))
    before = W.partitionBy(*cols).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (parts.groupBy(*cols, "_part").agg(F.sum("_c").alias("_t"))
               .select(*cols, "_part",
                       F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_offset")))
    inner = (W.partitionBy(*cols, "_part").orderBy(col(value))
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    upto = F.col("_offset") + F.sum("_c").over(inner)
    return (parts.join(offsets, [*keys, "_part"])
            .select(*cols, col(value), (upto - (F.col("_c") - 1) / 2.0).alias("rank")))
