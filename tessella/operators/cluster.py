"""Average-linkage clustering of rows.

Distances are rows ``i, j, d`` of two clusters, spread over the executors. In each round all pairs of
clusters that are each other's nearest merge at once; they are found by joining the nearest of every
cluster with itself. Average linkage allows that: merging one pair never brings another nearest pair
apart, so the tree is the sequential one (up to equal distances). A merge relabels both ends of every
distance by joins and adds up weighted distances. A round leaves about half of the distances, so all
of them together cost little more than the first. Merges, sizes and labels are tables as well: nothing
as long as the rows comes to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessella.frame import col, id_of, join_by_id, value_columns
from tessella.functions.blocks import block_count, pair_own_blocks, prepared, vectors
from tessella.functions.gram import matrix_of
from tessella.functions.ordering import numbered
from tessella.operators.correlate import BLOCK_ROWS, block_euclidean
from tessella.runtime import cut_lineage

# clusters left at which the rest of the tree, 2 million distances, is finished in one task
SMALL = 2048
MERGE = "a long, b long, height double, round int"


def _distances(rows: DataFrame, n: int, width: int, block_rows: int | None) -> DataFrame:
    """``i, j, d``: the distance of each unordered pair of positions, the smaller one first."""
    blocks = block_count(n, width, block_rows, BLOCK_ROWS)

    def meet(left: pa.Table, right: pa.Table, same: bool) -> pa.Table:
        d, _ = block_euclidean(matrix_of(left["vec"]), matrix_of(right["vec"]))
        a, b = left["pos"].to_numpy(), right["pos"].to_numpy()
        x, y = np.nonzero(a[:, None] < b[None, :]) if same else (v.ravel() for v in np.indices(d.shape))
        return pa.table({"i": np.minimum(a[x], b[y]), "j": np.maximum(a[x], b[y]), "d": d[x, y]})

    return pair_own_blocks(rows, blocks, meet, "i long, j long, d double")


def _merged(pairs: DataFrame, sizes: DataFrame, number: int) -> DataFrame:
    """``a, b, height, round, share`` of the clusters that are each other's nearest, a < b.

    ``share`` is the part of a's members in both. Of equal distances the smaller cluster is nearer,
    so the first of the nearest pairs of all is always among them and every round merges.
    """
    ways = pairs.union(pairs.select("j", "i", "d"))
    near = ways.groupBy("i").agg(F.min(F.struct("d", "j")).alias("m")).select("i", "m.j", "m.d")
    other = near.select(F.col("i").alias("j"), F.col("j").alias("i"))
    found = near.join(other, ["i", "j"]).where("i < j").select(
        F.col("i").alias("a"), F.col("j").alias("b"), F.col("d").alias("height"), F.lit(number).alias("round"))
    a, b = (sizes.select(F.col("pos").alias(c), F.col("size").alias(f"size_{c}")) for c in "ab")
    return cut_lineage(found.join(a, "a").join(b, "b").select(
        "a", "b", "height", "round", (F.col("size_a") / (F.col("size_a") + F.col("size_b"))).alias("share")))


def _relabelled(df: DataFrame, merges: DataFrame, column: str, weight: str) -> DataFrame:
    """The column with b in place of a, and the weight that the old cluster has in the new one."""
    moved = merges.select(F.col("a").alias("_old"), F.col("a").alias("_new"), F.col("share").alias("_w")).union(
        merges.select("b", "a", 1 - F.col("share")))
    return (df.join(moved, F.col(column) == F.col("_old"), "left")
            .withColumn(column, F.coalesce("_new", column)).withColumn(weight, F.coalesce("_w", F.lit(1.0)))
            .drop("_old", "_new", "_w"))


def _round(pairs: DataFrame, sizes: DataFrame, merges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distances and sizes after the merges of a round."""
    ends = _relabelled(_relabelled(pairs, merges, "i", "wi"), merges, "j", "wj").where("i <> j")
    part = F.col("d") * F.col("wi") * F.col("wj")
    # four terms at most; sorted, so that the sum doesn't depend on the order of arrival
    total = F.aggregate(F.array_sort(F.collect_list(part)), F.lit(0.0), lambda x, y: x + y)
    pairs = ends.groupBy(F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j")).agg(total.alias("d"))
    sizes = _relabelled(sizes, merges, "pos", "_s").groupBy("pos").agg(F.sum("size").alias("size"))
    return cut_lineage(pairs), cut_lineage(sizes)


def _rest_of_tree(table: pa.Table, number: int) -> list[tuple[int, int, float, int]]:
    """Merges of the clusters that are left, round by round in one task."""
    names = table["pos"].to_numpy()
    order = np.argsort(names)
    names, sizes = names[order], table["size"].to_numpy()[order]
    dist = np.full((len(names), len(names)), np.inf)
    for other, d in zip(table["other"].combine_chunks(), table["pos"].to_numpy()):
        if len(other.values):
            at, to = np.searchsorted(names, d), np.searchsorted(names, other.values.field("j").to_numpy())
            dist[at, to] = dist[to, at] = other.values.field("d").to_numpy()
    out = []
    while len(names) > 1:
        here = np.arange(len(names))
        near = dist.argmin(axis=1)
        a = here[(near[near] == here) & (here < near)]
        b = near[a]
        out += [(int(names[x]), int(names[y]), float(dist[x, y]), number) for x, y in zip(a, b)]
        share = sizes[a] / (sizes[a] + sizes[b])
        kept = np.setdiff1d(here, b)
        for _ in range(2):  # columns, then rows
            dist[:, a] = dist[:, a] * share + dist[:, b] * (1 - share)
            dist = dist.T
        sizes[a] += sizes[b]
        names, sizes, dist = names[kept], sizes[kept], dist[np.ix_(kept, kept)]
        np.fill_diagonal(dist, np.inf)
        number += 1
    return out


def _finish(table: pa.Table, number: int) -> pa.Table:
    columns = list(zip(*_rest_of_tree(table, number))) or [[]] * 4
    return pa.table({n: pa.array(c, k) for n, c, k in zip(
        ("a", "b", "height", "round"), columns, (pa.int64(), pa.int64(), pa.float64(), pa.int32()))})


def _clusters(table: pa.Table, num_clusters: int) -> pa.Table:
    """``pos, c`` of rows of which none has merged before: the number of each row's cluster."""
    root = {int(p): int(p) for p in sorted(table["pos"].to_pylist())}
    merges = sorted(_rest_of_tree(table, 0), key=lambda m: (m[2], m[3], m[0]))
    for a, b, _, _ in merges[:len(root) - num_clusters]:
        root[b] = a
    for p in root:  # a cluster merges into a smaller one, which is settled before
        root[p] = root[root[p]]
    names = {r: c for c, r in enumerate(sorted(set(root.values())))}
    return pa.table({"pos": pa.array(list(root), pa.int64()),
                     "c": pa.array([names[r] for r in root.values()], pa.int64())})


def _labels(positions: DataFrame, merges: DataFrame) -> DataFrame:
    """``pos, root``: the smallest position of each position's cluster after the given merges.

    A cluster merges into a smaller one once at most, so merges are pointers; every join doubles the
    steps that they take.
    """
    steps = cut_lineage(positions.join(merges.select(F.col("b").alias("pos"), F.col("a").alias("root")), "pos", "left")
                        .select("pos", F.coalesce("root", "pos").alias("root")))
    while True:
        ahead = steps.select(F.col("pos").alias("root"), F.col("root").alias("_next"))
        moved = cut_lineage(steps.join(ahead, "root").select("pos", F.col("_next").alias("root"),
                                                             (F.col("_next") != F.col("root")).alias("moved")))
        steps = moved.select("pos", "root")
        if moved.where("moved").isEmpty():
            return steps


def hclust(df: DataFrame, num_clusters: int, id_col: str | None = None, small: int = SMALL,
           block_rows: int | None = None) -> DataFrame:
    """``id, cluster``: Euclidean average-linkage clusters ``cluster_0…`` by smallest member id.

    Missing and infinite cells are an error, as distances to such rows say nothing about linkage.
    """
    id_col = id_of(df, id_col)
    rows, n = prepared(vectors(df, id_col))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    if not rows.where(bad).isEmpty():
        raise ValueError("unable to cluster: missing or infinite values encountered")
    if not 1 <= num_clusters <= n:
        raise ValueError(f"num_clusters has to be between 1 and the number of rows ({n})")
    rows = numbered(rows, ["id"], "pos")
    pairs = _distances(rows, n, len(value_columns(df, id_col)), block_rows)
    sizes = rows.select("pos", F.lit(1.0).alias("size"))
    merges, left, number = [], n, 0
    if left > small:
        pairs = cut_lineage(pairs)
    while left > small:
        made = _merged(pairs, sizes, number)
        merges.append(made.drop("share"))
        pairs, sizes = _round(pairs, sizes, made)
        left, number = left - made.count(), number + 1
    # a row per cluster with its distances to larger ones, all in one task
    rest = sizes.join(pairs.groupBy(F.col("i").alias("pos")).agg(
        F.collect_list(F.struct("j", "d")).alias("other")), "pos", "left").withColumn(
        "other", F.coalesce("other", F.array().cast("array<struct<j:bigint,d:double>>")))
    rest = rest.groupBy(F.lit(0).alias("g"))
    if n <= small:
        found = rest.applyInArrow(lambda t: _clusters(t, num_clusters), "pos long, c long")
        return rows.select("id", "pos").join(found, "pos").select("id", _name("c"))
    merges.append(rest.applyInArrow(lambda t: _finish(t, number), MERGE))
    every = merges[0]
    for more in merges[1:]:
        every = every.union(more)
    lowest = numbered(every, ["height", "round", "a"], "place").where(F.col("place") < n - num_clusters)
    labels = _labels(rows.select("pos"), lowest)
    names = numbered(labels.select("root").distinct(), ["root"], "_c")
    return (rows.select("id", "pos").join(labels, "pos").join(names, "root")
            .select("id", _name("_c")))


def _name(number: str) -> Column:
    return F.concat(F.lit("cluster_"), F.col(number).cast("string")).alias("cluster")


def cluster_hclust(df: DataFrame, num_clusters: int, col_name: str = "clusters",
                   id_col: str | None = None, **options) -> DataFrame:
    """Append the cluster of each row as a text column."""
    id_col = id_of(df, id_col)
    labels = hclust(df, num_clusters, id_col, **options)
    labels = labels.withColumnRenamed("cluster", "_cluster")
    return join_by_id(df, labels, id_col).select(
        *[col(c) for c in df.columns], F.col("_cluster").alias(col_name))
