"""Rank statistics of pairs of columns from ranges of sorted values.

Each column is cut at quantiles. A value that is a cut is a range by itself, as it may be a large part
of the rows; what lies between two cuts is a range of bounded size. For every column its rows meet range
by range, all other columns with them, so each pair of columns is seen in the order of either one. Rows
are never paired: within a range local sorts count, between ranges the sizes do.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessella.functions.gram import array_column, matrix_of

# rows between two cuts, and cuts of a column at most: beyond 16 million rows ranges grow with them
RANGE_ROWS, MOST_CUTS = 2**16, 256
# parts that the rows of a cut are dealt to where they only need their counts
PARTS = 64


def cuts_of(rows: DataFrame, width: int, n: int, range_rows: int = RANGE_ROWS) -> list[np.ndarray]:
    """Distinct cuts of each column of ``vec``."""
    count = min(MOST_CUTS, -(-n // range_rows))
    if count <= 1:
        return [np.empty(0)] * width
    probs = [k / count for k in range(1, count)]
    found = rows.agg(*[F.percentile_approx(F.col("vec")[c], probs, 100 * count).alias(f"c{c}")
                       for c in range(width)]).first()
    return [np.unique(np.array(found[c] or [], float)) for c in range(width)]


def range_codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Number of the range of each cell, odd for a cut itself; -1 where the cell is missing."""
    out = np.full(x.shape, -1, np.int64)
    for c, own in enumerate(cuts):
        here = ~np.isnan(x[:, c])
        at = np.searchsorted(own, x[here, c])
        equal = (own[np.minimum(at, len(own) - 1)] == x[here, c]) if len(own) else np.zeros(len(at), bool)
        out[here, c] = 2 * at + equal
    return out


def by_range(rows: DataFrame, cuts: list[np.ndarray], cut_rows: bool) -> DataFrame:
    """``c, range, part, row, vec``: the rows of each column, range by range.

    The rows of a cut are dealt to parts, and left out unless ``cut_rows``.
    """
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch["vec"])
            codes = range_codes(x, cuts)
            row = batch["row"].to_numpy()
            for c in range(x.shape[1]):
                code = codes[:, c]
                keep = np.flatnonzero((code >= 0) if cut_rows else (code >= 0) & (code % 2 == 0))
                part = np.where(code[keep] % 2, row[keep] % PARTS, 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keep), c, np.int32)), pa.array(code[keep].astype(np.int32)),
                     pa.array(part.astype(np.int32)), pa.array(row[keep]), array_column(x[keep])],
                    ["c", "range", "part", "row", "vec"])

    return rows.mapInArrow(deal, "c int, range int, part int, row long, vec array<double>")


def range_counts(rows: DataFrame, cuts: list[np.ndarray], odd_only: bool = False) -> DataFrame:
    """``c, range, d, counts``: of the rows in a range of column c, how many are in each range of d.

    Tasks add up their own counts first.
    """
    sizes = [2 * len(own) + 1 for own in cuts]
    ends = np.cumsum(sizes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            codes = range_codes(matrix_of(batch["vec"]), cuts)
            # a row's cells as places in one line of all ranges
            place = np.where(codes >= 0, codes + (ends - sizes), -1)
            for c in range(codes.shape[1]):
                for r in np.unique(codes[:, c]):
                    if r < 0 or odd_only and r % 2 == 0:
                        continue
                    cells = place[codes[:, c] == r]
                    found = np.bincount(cells[cells >= 0], minlength=ends[-1])
                    total[c, r] = total.get((c, r), 0) + found
        for (c, r), found in total.items():
            parts = np.split(found, ends[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * len(parts), pa.int32()), pa.array([r] * len(parts), pa.int32()),
                 pa.array(range(len(parts)), pa.int32()), pa.array(parts, pa.list_(pa.int64()))],
                ["c", "range", "d", "counts"])

    return rows.mapInArrow(count, "c int, range int, d int, counts array<long>")


def inversions(x: np.ndarray) -> int:
    """Pairs of whole numbers from 0 below their length that stand in the wrong order."""
    n, total, width = len(x), 0, 1
    size = 1 << max(0, (n - 1).bit_length())
    line = np.full(size, n, np.int64)  # what is filled up stands at the end, in order
    line[:n] = x
    while width < size:
        halves = line.reshape(-1, 2, width)
        block = np.arange(len(halves))[:, None] * (n + 1)
        left, right = (halves[:, 0] + block).ravel(), (halves[:, 1] + block).ravel()
        # of the left half of each pair, those that are larger than a number of the right one
        upto = np.searchsorted(left, right, side="right")
        total += int((np.repeat(np.arange(1, len(halves) + 1), width) * width - upto).sum())
        line = np.sort(halves.reshape(-1, 2 * width), axis=1).ravel()
        width *= 2
    return total


def _tied(*columns: np.ndarray) -> int:
    """Pairs of sorted rows that are equal in all columns."""
    if not len(columns[0]):
        return 0
    new = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))
    size = np.diff(np.append(np.flatnonzero(new), len(new)))
    return int((size * (size - 1) // 2).sum())


def concordance(x: np.ndarray, y: np.ndarray, part: np.ndarray | None = None) -> tuple[int, int]:
    """Sum of the signs of (difference in x) times (difference in y) over all pairs, and pairs tied in x.

    With ``part``, numbers that never fall as y rises, only pairs within a part count.
    """
    part = np.zeros(len(x), np.int64) if part is None else part
    order = np.lexsort((y, x, part))
    x, y, part = x[order], y[order], part[order]
    rank = np.unique(y, return_inverse=True)[1]
    by_y = np.argsort(rank, kind="stable")
    tied_x, both = _tied(part, x), _tied(part, x, y)
    free = _tied(part) - tied_x - _tied(part[by_y], rank[by_y]) + both
    # sorted by part, then x: parts lie apart in y as well, so no inversion crosses them
    return free - 2 * inversions(rank), tied_x


def between_ranges(counts: np.ndarray) -> int:
    """The same sum over pairs of rows that differ in both ranges, from the rows per pair of ranges."""
    before = np.zeros_like(counts)
    before[1:] = np.cumsum(counts, axis=0)[:-1]
    upto = np.cumsum(before, axis=1)
    below = np.zeros_like(counts)
    below[:, 1:] = upto[:, :-1]
    above = upto[:, -1:] - upto
    return int((counts * (below - above)).sum())
