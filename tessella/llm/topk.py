"""Exact top-k search by inner product: branch and bound over blocks of dimensions.

Vectors lie dimension by dimension (vertical layout). Scores of a query against a block of
candidates grow one block of dimensions at a time; what the rest can still add is bounded by the
product of the remaining norms (Cauchy-Schwarz). A candidate whose bound falls below the query's
k-th best guaranteed score is dropped, and once few are left the survivors are compacted into a list
of pairs. Scores are whole numbers, so the result is exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.functions.blocks import pair_blocks
from tessella.llm.common import materialize

#: bytes of one block of candidates or queries, and cells of one table of partial scores
BLOCK_BYTES, TILE_CELLS = 32 << 20, 1 << 20
DIMENSION_BLOCK = 16
#: share of survivors below which they are compacted into pairs
COMPACT = 0.25
LONG = (-(1 << 63), (1 << 63) - 1)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of an array column as doubles; shorter vectors end in zeros."""
    lists = column.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _tile(q: np.ndarray, c: np.ndarray, cuts: list[slice], k: int, floor: np.ndarray,
          barred: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs ``query row, candidate column, score`` that may belong to the k best.

    ``q`` is queries x dimensions, ``c`` dimensions x candidates, ``floor`` a score per query that the
    k best reach anyhow, ``barred`` marks pairs that don't count. Doubles are exact here.
    """
    # norms of what is left before each block; a hair more, so that rounding can't cut a tie
    q_rest = [np.sqrt((q[:, s.start:] ** 2).sum(axis=1)) * (1 + 1e-9) for s in cuts] + [np.zeros(len(q))]
    c_rest = [np.sqrt((c[s.start:] ** 2).sum(axis=0)) * (1 + 1e-9) for s in cuts] + [np.zeros(c.shape[1])]
    score = np.where(barred, -np.inf, 0.0)
    rows = cols = flat = None
    for i, s in enumerate(cuts):
        if rows is None:
            score += q[:, s] @ c[s]
            rest = q_rest[i + 1][:, None] * c_rest[i + 1]
            if c.shape[1] >= k:
                sure = np.partition(score - rest, c.shape[1] - k, axis=1)[:, c.shape[1] - k]
                floor = np.maximum(floor, sure)
            alive = (score + rest >= floor[:, None]) & ~barred
            if alive.mean() < COMPACT or i + 1 == len(cuts):
                rows, cols = np.nonzero(alive)
                flat = score[rows, cols]
        else:
            flat = flat + np.einsum("pd,dp->p", q[rows, s], c[s][:, cols])
            alive = flat + q_rest[i + 1][rows] * c_rest[i + 1][cols] >= floor[rows]
            rows, cols, flat = rows[alive], cols[alive], flat[alive]
    return rows, cols, flat


def _best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best per row: higher score, then smaller id."""
    order = np.lexsort((ids, -scores, rows))
    row = rows[order]
    first = np.searchsorted(row, row)
    return order[np.arange(len(row)) - first < k]


def _search(queries: pa.Table, others: pa.Table, k: int, width: int) -> pa.Table:
    q_ids, c_ids = queries["id"].to_numpy(), others["id"].to_numpy()
    q, c = _matrix(queries["vec"], width), np.ascontiguousarray(_matrix(others["vec"], width).T)
    largest = np.sqrt((q ** 2).sum(axis=1).max(initial=0)) * np.sqrt((c ** 2).sum(axis=0).max(initial=0))
    found = ([], [], [])
    if largest >= 1 << 52:  # doubles no longer hold the sums: whole numbers of any size
        big_q, big_c = (np.vectorize(int, otypes=[object])(m) if m.size else m for m in (q, c))
        for i, row in enumerate(big_q):
            scores = np.array([min(max(v, LONG[0]), LONG[1]) for v in row @ big_c], np.int64)
            ok = np.flatnonzero(c_ids != q_ids[i])
            best = ok[np.lexsort((c_ids[ok], -scores[ok].astype(object)))[:k]]
            for out, part in zip(found, (np.full(len(best), q_ids[i]), c_ids[best], scores[best])):
                out.append(part)
    else:
        order = np.argsort(-(c ** 2).sum(axis=1), kind="stable")  # most mass first
        q, c = q[:, order], c[order]
        cuts = [slice(a, min(a + DIMENSION_BLOCK, width)) for a in range(0, width, DIMENSION_BLOCK)]
        cols = 1 << 13
        step = max(1, TILE_CELLS // cols)
        for a in range(0, len(q), step):
            own = q_ids[a:a + step]
            floor = np.full(len(own), -np.inf)
            best = tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.float64))
            for b in range(0, len(c_ids), cols):
                r, j, s = _tile(q[a:a + step], c[:, b:b + cols], cuts, k, floor,
                                own[:, None] == c_ids[None, b:b + cols])
                best = tuple(np.concatenate(x) for x in zip(best, (r, c_ids[b + j], s)))
                best = tuple(x[_best(*best, k)] for x in best)
                full = np.bincount(best[0], minlength=len(own)) >= k
                least = np.full(len(own), np.inf)
                np.minimum.at(least, best[0], best[2])
                floor = np.where(full, least, floor)
            for out, part in zip(found, (own[best[0]], best[1], best[2].astype(np.int64))):
                out.append(part)
    return pa.table({n: pa.array(np.concatenate(x) if x else [], pa.int64())
                     for n, x in zip(("query_id", "id", "score"), found)})


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, vec``: floor(scale * x) of each component; rows that can't take part are left out.

    Those are rows without an id, without a vector, or with a null or non-finite component. Of
    several vectors under one id the smallest (by its components in order) counts.
    """
    vec = F.col(vector_col)
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.where(F.col(id_col).isNotNull() & vec.isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(vec, lambda x: F.lit(scale) * x.cast("double")).alias("vec"))
            # doubles from 2 ** 53 on are whole, and floor gives a long
            .select("id", F.transform("vec", lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double"))
                                      .otherwise(x)).alias("vec"))
            .groupBy("id").agg(F.min("vec").alias("vec")))


def top_k(vectors: DataFrame, is_query: Column, k: int, block_rows: int | None = None) -> DataFrame:
    """``query_id, rank, id, score``: each query's k highest inner products with all other rows.

    ``vectors`` is ``id, vec`` of whole numbers with one row per id (``whole_vectors``); a shorter
    vector counts as if it ended in zeros; scores beyond a long become the nearest long. Ties go to
    the smaller id; a query with fewer than k other rows returns them all. Queries and candidates
    are dealt into blocks of bounded bytes by a hash of the id, every pair of blocks is one task and
    returns k rows per query at most.
    """
    vectors = materialize(vectors, "vectors")
    found = vectors.agg(F.count("*"), F.sum(is_query.cast("long")), F.max(F.size("vec"))).first()
    n, n_queries, width = (v or 0 for v in found)
    width = max(1, width)
    rows = block_rows or max(1, BLOCK_BYTES // (8 * width))
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # as many blocks as there are tasks to run, unless they get very small
    blocks = max(math.ceil(n / rows), min(parts, math.ceil(n / 4096)), 1)
    searched = pair_blocks(vectors.where(is_query), vectors, max(1, math.ceil(n_queries / rows)), blocks,
                           lambda q, c: _search(q, c, k, width), "query_id long, id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (searched.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score"))
