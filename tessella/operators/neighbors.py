"""Nearest rows: imputation from them and the neighbour graph.

Rows meet block by block. A pair of blocks keeps the k best of its own rows, and the best of those
are picked per row afterwards, so the result is exact and nothing else leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from tessella.frame import col, double, id_of, join_by_id, value_columns
from tessella.functions.blocks import BLOCK_BYTES, block_count, pair_blocks, prepared, vectors
from tessella.functions.gram import cross_sums, matrix_of, named
from tessella.operators.correlate import (DIFFERENCE_CELLS, block_euclidean, both_ways, column_distances,
                                          has_negative_median)
from tessella.operators.project import project_pca
from tessella.runtime import cut_lineage

# cells of one distance table held at a time
DISTANCE_CELLS = 2**23
# rows whose least distance is taken together
STRETCH = 64
# rounding of a sum of products, relative to its terms: twice the unit of a double, twice over
ROUNDING = 4 * float(np.finfo(float).eps)
# centres that rows are dealt to at most
MOST_CENTRES = 4096
NEIGHBORS = pa.schema([("id", pa.string()), ("neighbor", pa.string()), ("distance", pa.float64())])

Distance = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _euclidean(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return block_euclidean(x, y)[0]


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """One minus the cosine over the cells both rows have; 1 where either has no length there."""
    mx, my = (~np.isnan(x)).astype(float), (~np.isnan(y)).astype(float)
    x, y = np.nan_to_num(x), np.nan_to_num(y)
    lengths = np.sqrt((x * x) @ my.T) * np.sqrt(mx @ (y * y).T)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(lengths > 0, 1.0 - (x @ y.T) / lengths, 1.0)


def _gower(spans: np.ndarray) -> Distance:
    """Mean of the absolute differences over the column ranges, present cells only."""
    def distance(x, y):
        total, n = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
        for c, span in enumerate(spans):
            d = np.abs(x[:, c, None] - y[None, :, c]) / (span or 1.0)
            n += ~np.isnan(d)
            total += np.nan_to_num(d)
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(n > 0, total / n, np.nan)
    return distance


def _by_id(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.sort_by("id")
    return table["id"].to_numpy(), matrix_of(table["vec"])


def _nearest(distance: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k smallest per row; equal distances go to the smaller id (sorted before)."""
    distance = np.where(np.isnan(distance), np.inf, distance)
    if k >= distance.shape[1]:
        return np.argsort(distance, axis=1, kind="stable")
    near = np.sort(np.argpartition(distance, k - 1, axis=1)[:, :k], axis=1)
    found = np.take_along_axis(distance, near, axis=1)
    near = np.take_along_axis(near, np.argsort(found, axis=1, kind="stable"), axis=1)
    # rows where more than k are as near as the last one: only a full sort knows the smaller ids
    tied = (distance <= found.max(axis=1, keepdims=True)).sum(axis=1) > k
    if tied.any():
        near[tied] = np.argsort(distance[tied], axis=1, kind="stable")[:, :k]
    return near


def _nearest_complete(x: np.ndarray, y: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Rows of x, their k nearest rows of y and the distances, by row and then from near to far, for finite cells.

    ``own`` is the place of each row of x in y, or -1; it is left out. One product orders the rows of y, up
    to rounding. The k-th smallest of the least values of some stretches of y is no less than the k-th
    smallest of all, so only what isn't above it, and a hair more for rounding, is compared by differences.
    None where the cells are too large for such a product.
    """
    origin, cells, others = x.mean(axis=0), x, y  # large offsets are taken off, as in block_euclidean
    x, y = x - origin, y - origin
    with np.errstate(over="ignore", invalid="ignore"):
        half = (y * y).sum(axis=1) / 2
        lengths = np.sqrt((x * x).sum(axis=1))
        hair = ROUNDING * (x.shape[1] + 8) * (lengths * np.sqrt(2 * half.max()) + half.max())
    if not np.isfinite(hair).all():
        return None
    least = max(1, min(STRETCH, len(y) // (4 * k)))  # rows of y in a stretch
    whole = len(y) - len(y) % least
    left = np.hstack([x, np.ones((len(x), 1))])
    right = np.vstack([-y.T, half])
    out, step = [], max(1, DISTANCE_CELLS // len(y))
    for start in range(0, len(x), step):
        score = left[start:start + step] @ right  # half the squared distance, less half the row's squared length
        rows = len(score)
        at = np.flatnonzero(own[start:start + rows] >= 0)
        score[at, own[start:start + rows][at]] = np.inf
        low = score[:, :whole].reshape(rows, -1, least).min(axis=2)
        if whole < len(y):
            low = np.hstack([low, score[:, whole:].min(axis=1, keepdims=True)])
        bound = np.partition(low, k - 1, axis=1)[:, k - 1] if k <= low.shape[1] else np.full(rows, np.inf)
        i, j = np.nonzero(score <= (bound + hair[start:start + rows])[:, None])
        keep = j != own[start + i]
        i, j = i[keep], j[keep]
        d = np.empty(len(i))
        part = max(1, DIFFERENCE_CELLS // max(1, x.shape[1]))
        for a in range(0, len(i), part):
            d[a:a + part] = np.sqrt(((cells[start + i[a:a + part]] - others[j[a:a + part]]) ** 2).sum(axis=1))
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)  # within its row
        out.append((start + i[place < k], j[place < k], d[place < k]))
    return tuple(np.concatenate(c) for c in zip(*out))


def knn_donors(df: DataFrame, k: int, distance: Distance, id_col: str | None = None,
               block_rows: int | None = None) -> DataFrame:
    """``id, column, donor, distance, value``: the k nearest rows that have the missing cell."""
    cols = value_columns(df, id_col)
    rows, n = prepared(vectors(df, id_col))
    gaps = rows.where(F.exists("vec", lambda x: x.isNull()))
    sizes = [block_count(size, len(cols), block_rows) for size in (gaps.count(), n)]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        (ids, x), (donors, y) = _by_id(left), _by_id(right)
        out: list[tuple] = []
        step = max(1, DISTANCE_CELLS // max(1, len(y)))
        for start in range(0, len(x), step):
            part = x[start:start + step]
            d = distance(part, y)
            for c in range(x.shape[1]):
                need = np.flatnonzero(np.isnan(part[:, c]))
                have = np.flatnonzero(~np.isnan(y[:, c]))
                if not len(need) or not len(have):
                    continue
                near = _nearest(d[np.ix_(need, have)], k)
                donor = have[near]
                dist = np.take_along_axis(d[need], donor, axis=1)
                keep = ~np.isnan(dist)
                out.append((np.broadcast_to(ids[start + need][:, None], donor.shape)[keep],
                            np.full(keep.sum(), c), donors[donor][keep], dist[keep],
                            y[donor, c][keep]))
        names = ("id", "c", "donor", "distance", "value")
        parts = list(zip(*out)) or [[np.empty(0)]] * 5
        kinds = (pa.string(), pa.int32(), pa.string(), pa.float64(), pa.float64())
        return pa.table({n: pa.array(np.concatenate(v), kind)
                         for n, v, kind in zip(names, parts, kinds)})

    found = pair_blocks(gaps, rows, *sizes, meet,
                        "id string, c int, donor string, distance double, value double")
    nearest = W.partitionBy("id", "c").orderBy("distance", "donor")
    names = F.array(*[F.lit(c) for c in cols])
    return (found.withColumn("_n", F.row_number().over(nearest)).where(F.col("_n") <= k)
            .select("id", names[F.col("c")].alias("column"), "donor", "distance", "value"))


def impute_knn(df: DataFrame, k: int = 5, metric: str = "euclidean", agg: str = "mean",
               id_col: str | None = None, block_rows: int | None = None) -> DataFrame:
    """Fill missing cells from the k nearest rows that have the column.

    Distances use the cells both rows have. A cell without any comparable donor gets the column
    mean. ``metric='gower', agg='median'`` is the range-scaled variant.
    """
    id_col = id_of(df, id_col)
    cols = value_columns(df, id_col)
    if metric == "gower":
        row = df.agg(*[(F.max(double(c)) - F.min(double(c))).alias(c) for c in cols]).first()
        distance = _gower(np.array([row[i] or 0.0 for i in range(len(cols))]))
    elif metric == "euclidean":
        distance = _euclidean
    else:
        raise ValueError("metric is euclidean or gower")
    donors = knn_donors(df, k, distance, id_col, block_rows)
    combine = {"mean": F.avg, "median": lambda v: F.percentile(v, F.lit(0.5))}[agg]
    found = (donors.groupBy("id", "column").agg(combine(F.col("value")).alias("v"))
             .groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("column", "v")))
                                .alias("_found")))
    means = df.agg(F.array(*[F.avg(double(c)) for c in cols]).alias("m")).scalar()
    joined = join_by_id(df.withColumn("_means", means), found, id_col, "left")
    return joined.select(col(id_col), *[
        F.coalesce(double(c), F.col("_found")[c], F.col("_means")[i]).alias(c) for i, c in enumerate(cols)])


def layout_neighbors(rows: int) -> int:
    """The number that layouts take: a tenth of the rows, at least 5, at most 500 or all others."""
    return min(500, min(rows - 1, max(5, round(rows / 10))))


def layout_metric(df: DataFrame, id_col: str | None = None) -> str:
    """The metric that layouts take: cosine when a median row correlation is negative."""
    return "cosine" if has_negative_median(df, id_of(df, id_col)) else "euclidean"


def reachable(centre: np.ndarray, radius: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Which blocks may hold a row within ``reach`` of one of each block, by the triangle inequality."""
    apart = np.stack([np.linalg.norm(centre - c, axis=1) for c in centre])
    least = apart - radius[:, None] - radius[None, :]
    return least <= reach[:, None] + 1e-9 * (1 + apart + radius[:, None])  # a hair more, for rounding


def _first_pairs(centre: np.ndarray, same: np.ndarray, members: np.ndarray, k: int) -> np.ndarray:
    """Each block with those of its own centre, and with the nearest others until there are k rows besides one."""
    met = same[:, None] == same[None, :]
    for a in range(len(centre)):
        for b in np.argsort(np.linalg.norm(centre - centre[a], axis=1), kind="stable"):
            if members[met[a]].sum() > k:
                break
            met[a, b] = True
    return met


def _pruned(rows: DataFrame, width: int, n: int, k: int, block_rows: int | None,
            meet: Callable[[pa.Table, pa.Table], pa.Table]) -> tuple[DataFrame, int, int]:
    """The k nearest rows of complete rows under the Euclidean distance, and the pairs of blocks that met
    of all there are.

    Rows go to the nearest of some centres; a centre with many rows has several blocks. Blocks first meet
    themselves and their surroundings, which says how far the k-th neighbour is at most; then only
    the pairs of blocks meet whose centres and radii leave room for a nearer one.
    """
    spark = rows.sparkSession
    size = -(-n // block_count(n, width, block_rows))  # no larger than a task can hold, and a pair for every core
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(min(MOST_CENTRES, -(-n // size))).select("vec").collect()
    centres = np.array([r["vec"] for r in chosen], float)

    @F.arrow_udf("struct<centre int, away double>")
    def nearest(vec: pa.Array) -> pa.Array:
        x, step = matrix_of(vec), max(1, DISTANCE_CELLS // len(centres))
        near, away = np.zeros(len(x), np.int32), np.zeros(len(x))
        for a in range(0, len(x), step):
            d = _euclidean(x[a:a + step], centres)
            near[a:a + step], away[a:a + step] = d.argmin(axis=1), d.min(axis=1)
        return pa.StructArray.from_arrays([pa.array(near), pa.array(away)], ["centre", "away"])

    placed = cut_lineage(rows.select("id", "vec", nearest("vec").alias("_c")).select("id", "vec", "_c.centre", "_c.away"))
    stats = {r["centre"]: (r["n"], r["r"]) for r in placed.groupBy("centre").agg(
        F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()}  # a row per centre at most
    pieces = [-(-stats.get(c, (0, 0.0))[0] // size) for c in range(len(centres))]
    offset = [0, *np.cumsum(pieces).tolist()]
    same = np.repeat(np.arange(len(centres)), pieces)
    radius = np.array([stats[c][1] for c in same])
    members = np.array([stats[c][0] / pieces[c] for c in same])
    at = F.lit(offset[:-1])[F.col("centre")] + F.pmod(F.xxhash64("id"), F.greatest(F.lit(pieces)[F.col("centre")], F.lit(1)))
    placed = placed.select("id", "vec", at.cast("int").alias("block"))

    def run(met: np.ndarray) -> DataFrame:
        pairs = spark.createDataFrame([(int(a), int(b)) for a, b in np.argwhere(met)], "_a int, _b int")
        left = placed.join(pairs, F.col("block") == F.col("_a")).select("_a", "_b", "id", "vec")
        right = placed.join(pairs, F.col("block") == F.col("_b")).select("_a", "_b", "id", "vec")
        right = right.select(*[F.col(c).alias(c) for c in right.columns])
        found = left.groupBy("_a", "_b").cogroup(right.groupBy("_a", "_b")).applyInArrow(
            lambda x, y: meet(x, y) if x.num_rows and y.num_rows else NEIGHBORS.empty_table(),
            "id string, neighbor string, distance double")
        order = W.partitionBy("id").orderBy("distance", "neighbor")
        return found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")

    met = _first_pairs(centres[same], same, members, k)
    first = cut_lineage(run(met))
    last = first.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("d"))
    far = F.when(F.col("n") == k, F.col("d")).otherwise(F.lit(float("inf")))
    reach = {r["block"]: r["reach"] for r in placed.select("id", "block").join(last, "id", "left")
             .groupBy("block").agg(F.max(far).alias("reach")).collect()}  # a row per block
    more = reachable(centres[same], radius, np.array([reach.get(b, 0.0) for b in range(len(same))])) & ~met
    found = first.unionByName(run(more)) if more.any() else first
    return found, int(met.sum() + more.sum()), met.size


def _column_graph(df: DataFrame, k: int, metric: str, id_col: str) -> DataFrame:
    """The k nearest columns of every column, from one pass of sums over the rows."""
    if metric == "euclidean":
        pairs = column_distances(df, id_col).select("x_id", "y_id", "distance")
    else:
        cols = value_columns(df, id_col)
        lengths = F.sqrt("sxx") * F.sqrt("syy")
        apart = F.when(lengths > 0, 1 - F.try_divide(F.col("sxy"), lengths)).otherwise(F.lit(1.0))
        sums = cross_sums(df, cols, shift=False).where("i < j")
        pairs = named(sums.select("i", "j", apart.alias("distance")), cols, cols)
    nearest = W.partitionBy("x_id").orderBy("distance", "y_id")
    return (both_ways(pairs.where("distance is not null")).withColumn("rank", F.row_number().over(nearest))
            .where(F.col("rank") <= k)
            .select(F.col("x_id").alias("id"), F.col("y_id").alias("neighbor"), "rank", "distance"))


def knn_graph(df: DataFrame, k: int, metric: str = "euclidean", num_dims: int | None = None,
              id_col: str | None = None, block_rows: int | None = None, target: str = "rows") -> DataFrame:
    """``id, neighbor, rank, distance``: the exact k nearest neighbours of every row, or column.

    With ``num_dims`` the neighbours are those among that many principal components. Distances use
    the cells both rows have; under ``cosine`` a row without length is at distance 1 from all. Complete
    rows of more than one block leave out the blocks that are too far for their Euclidean neighbours.
    """
    id_col = id_of(df, id_col)
    if target == "columns":
        if num_dims is not None:
            df = project_pca(df, target="rows", num_dims=num_dims, id_col=id_col)
        return _column_graph(df, k, metric, id_col)
    if target != "rows":
        raise ValueError("target is rows or columns")
    if num_dims is not None:
        df = project_pca(df, num_dims=num_dims, id_col=id_col)
    rows, n = prepared(vectors(df, id_col))
    width = len(value_columns(df, id_col))
    distance = {"cosine": _cosine, "euclidean": _euclidean}[metric]
    blocks = block_count(n, width, block_rows)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        (ids, x), (others, y) = _by_id(left), _by_id(right)
        own_place = pc.fill_null(pc.index_in(pa.array(ids, pa.string()), value_set=pa.array(others, pa.string())), -1).to_numpy()
        if metric == "euclidean" and k > 0 and np.isfinite(x).all() and np.isfinite(y).all():
            made = _nearest_complete(x, y, own_place, k)
            if made is not None:
                i, j, near = made
                return pa.table({"id": pa.array(ids[i], pa.string()), "neighbor": pa.array(others[j], pa.string()),
                                 "distance": near})
        a, b, d = [], [], []
        step = max(1, DISTANCE_CELLS // max(1, len(y)))
        for start in range(0, len(x), step):
            part = distance(x[start:start + step], y)
            own = ids[start:start + step]
            at = np.flatnonzero(own_place[start:start + step] >= 0)
            part[at, own_place[start:start + step][at]] = np.nan
            near = _nearest(part, k)
            dist = np.take_along_axis(part, near, axis=1)
            keep = ~np.isnan(dist)
            a.append(np.broadcast_to(own[:, None], near.shape)[keep])
            b.append(others[near][keep])
            d.append(dist[keep])
        return pa.table({"id": pa.array(np.concatenate(a), pa.string()),
                         "neighbor": pa.array(np.concatenate(b), pa.string()),
                         "distance": np.concatenate(d)})

    gap = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    if metric == "euclidean" and n > (block_rows or BLOCK_BYTES // (8 * max(1, width))) and rows.where(gap).isEmpty():
        found, _, _ = _pruned(rows, width, n, k, block_rows, meet)
    else:
        found = pair_blocks(rows, rows, blocks, blocks, meet,
                            "id string, neighbor string, distance double")
    nearest = W.partitionBy("id").orderBy("distance", "neighbor")
    return (found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("id", "neighbor", "rank", "distance"))
