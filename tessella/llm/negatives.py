"""Hard negatives from blocks along a Hilbert curve, chosen by zone maps.

Candidates are ordered along a Hilbert curve through their most spread dimensions and written as
Parquet blocks of neighbours. A zone map keeps the least and largest value of each dimension of a block and its
labels. Interval arithmetic on an anchor and a zone map bounds the scores of the whole block from both
sides, which says what blocks the anchor has to read:

1. for its positives, first the blocks of highest bound, then all others whose bound still reaches the
   last positive found;
2. for its negatives, the blocks whose bounds meet the window of one of its positives, first those that
   promise most, then those that can still add to what was found.

Anchors of one block read the same blocks, so they meet a block together, in one task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.functions.blocks import pair_blocks
from tessella.llm.common import forget, materialize
from tessella.runtime import checkpoint_dir

#: dimensions of the curve and bits of each: together they fit a long
CURVE_DIMENSIONS, CURVE_BITS = 8, 7
#: rows of a block, blocks of one group of zone maps, anchors of one group
BLOCK_ROWS, ZONE_GROUP, ANCHOR_GROUP = 4096, 1024, 1024
#: blocks that an anchor reads before it chooses the rest
PROBED = 2
#: sums of products below this are exact in doubles
EXACT = 2.0 ** 52
LONG = (1 << 63) - 1


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of cells (rows x dimensions, each below 2 ** bits), after Skilling (2004)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where(x[n - 1] & q, flip ^ (q - 1), flip)
        q >>= 1
    x ^= flip
    place = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def _matrix(column, width: int) -> np.ndarray:
    """Rows of an array column as doubles; shorter vectors end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _known(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float) -> DataFrame:
    """``id, label, vec`` of the rows that take part; of several rows under one id the smallest."""
    vec = F.col(f"`{vector_col}`")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(vec, lambda x: F.lit(scale) * x.cast("double"))
    # doubles from 2 ** 53 on are whole, and floor gives a long
    whole = F.transform(whole, lambda x: F.when(F.abs(x) < 2.0 ** 53, F.floor(x).cast("double")).otherwise(x))
    return (vectors.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & vec.isNotNull() & ~bad)
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"),
                    whole.alias("vec"))
            .groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec"))


def _ordered(known: DataFrame, width: int, rows: int, block_rows: int) -> DataFrame:
    """The rows as blocks of neighbours along the curve: ``id, label, vec, block``, a folder per block."""
    spark = known.sparkSession
    at = [F.try_element_at("vec", F.lit(i + 1)) for i in range(width)]
    stats = known.agg(F.array(*[F.coalesce(F.stddev_pop(c), F.lit(0.0)) for c in at]),
                      F.array(*[F.min(c) for c in at]), F.array(*[F.max(c) for c in at])).first()
    spread, low, high = (np.array([v or 0.0 for v in (s or [0.0] * width)], float) for s in stats)
    used = np.argsort(-np.nan_to_num(spread), kind="stable")[:CURVE_DIMENSIONS]
    low, step = low[used], np.maximum(high[used] - low[used], 1e-300) / (1 << CURVE_BITS)

    @F.arrow_udf("long")
    def curve(vec: pa.Array) -> pa.Array:
        cells = (_matrix(vec, width)[:, used] - low) / step
        return pa.array(hilbert_index(np.clip(np.nan_to_num(cells), 0, (1 << CURVE_BITS) - 1), CURVE_BITS))

    blocks = max(1, -(-rows // block_rows))
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-blocks-{uuid.uuid4().hex}"
    (known.withColumn("place", curve("vec")).repartitionByRange(blocks, "place", "id")
     .sortWithinPartitions("place", "id").withColumn("block", F.spark_partition_id()).drop("place")
     .write.partitionBy("block").parquet(path))
    made = spark.read.schema("id long, label long, vec array<double>, block int").parquet(path)
    made._tessella_path = path
    return made


def _zone_maps(blocks: DataFrame, width: int) -> DataFrame:
    """``block, lo, hi, labels, first``: bounds of each dimension, the labels and the smallest id of a block."""
    schema = "block int, lo array<double>, hi array<double>, labels array<long>, first long"
    doubles, longs = pa.list_(pa.float64()), pa.list_(pa.int64())

    def zone(block: int, lo: np.ndarray, hi: np.ndarray, labels: np.ndarray, first: int) -> dict:
        return {"block": pa.array([block], pa.int32()), "lo": pa.array([lo], doubles), "hi": pa.array([hi], doubles),
                "labels": pa.array([labels], longs), "first": pa.array([first], pa.int64())}

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, block = _matrix(batch["vec"], width), batch["block"].to_numpy()
            label, ids = batch["label"].to_numpy(), batch["id"].to_numpy()
            for b in np.unique(block):
                own = block == b
                yield pa.RecordBatch.from_pydict(zone(int(b), x[own].min(axis=0), x[own].max(axis=0),
                                                      np.unique(label[own]), int(ids[own].min())))

    def joined(table: pa.Table) -> pa.Table:
        return pa.table(zone(table["block"][0].as_py(), _matrix(table["lo"], width).min(axis=0),
                             _matrix(table["hi"], width).max(axis=0),
                             np.unique(table["labels"].combine_chunks().flatten().to_numpy()),
                             table["first"].to_numpy().min()))

    return blocks.mapInArrow(bounds, schema).groupBy("block").applyInArrow(joined, schema)


def _bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score that each anchor can have with any row of each block."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        least, most = plus @ lo.T + minus @ hi.T, plus @ hi.T + minus @ lo.T
        size = np.abs(a) @ np.maximum(np.abs(lo), np.abs(hi)).T
        slack = np.where(size < EXACT, 0.0, size * 1e-9)  # beyond, sums are rounded
    least, most = least - slack, most + slack
    return np.where(np.isnan(least), -np.inf, least), np.where(np.isnan(most), np.inf, most)


def _scores(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products as longs; beyond the largest long, of either sign, they become that."""
    largest = np.sqrt((a ** 2).sum(axis=1).max(initial=0)) * np.sqrt((c ** 2).sum(axis=1).max(initial=0))
    if largest < EXACT:
        return (a @ c.T).astype(np.int64)
    big_a, big_c = ([[int(v) for v in row] for row in m] for m in (a, c))
    return np.array([[min(max(sum(map(int.__mul__, x, y)), -LONG), LONG) for y in big_c] for x in big_a], np.int64)


def _in_window(score: np.ndarray, positive: np.ndarray, low: int, high: int) -> np.ndarray:
    """Whether low * positive <= 100 * score <= high * positive."""
    if max(np.abs(score.astype(float)).max(initial=0), np.abs(positive.astype(float)).max(initial=0)) > 2.0 ** 55:
        score, positive = score.astype(object), positive.astype(object)
    return ((low * positive <= 100 * score) & (100 * score <= high * positive)).astype(bool)


def _top(score: np.ndarray, ids: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k best that count, per row: higher score, then smaller id."""
    rows, cols = np.nonzero(counts)
    order = np.lexsort((ids[cols], -score[rows, cols], rows))
    row = rows[order]
    order = order[np.arange(len(row)) - np.searchsorted(row, row) < k]
    return rows[order], cols[order]


def _holds(zones: pa.Table, labels: np.ndarray, other: bool) -> np.ndarray:
    """Which blocks hold a row of each anchor's label, or of another one."""
    sets = [set(s) for s in zones["labels"].to_pylist()]
    kinds, index = np.unique(labels, return_inverse=True)
    held = np.array([[bool(s - {k}) if other else k in s for s in sets] for k in kinds.tolist()], bool)
    return held.reshape(len(kinds), len(sets))[index]


def _table(columns: dict[str, np.ndarray], kinds: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({n: pa.array(columns[n], kinds[n]) for n in kinds})


def _longs(column: pa.ChunkedArray, k: int, empty: int) -> np.ndarray:
    """Rows of an array column of k longs at most, filled up."""
    lists = column.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    out = np.full((len(size), k), empty, np.int64)
    out[np.arange(k) < size[:, None]] = lists.flatten().to_numpy()
    return out


class _Search:
    """The blocks and zone maps, and what anchors do with them."""

    def __init__(self, blocks: DataFrame, zones: DataFrame, anchors: DataFrame, width: int, positives: int,
                 negatives: int, window: tuple[int, int]):
        self.blocks, self.zones, self.anchors, self.width = blocks, zones, anchors, width
        self.positives, self.negatives, self.window = positives, negatives, window
        self.zone_groups = max(1, -(-zones.count() // ZONE_GROUP))
        self.anchor_groups = max(1, -(-anchors.count() // ANCHOR_GROUP))

    def chosen(self, anchors: DataFrame, probe: bool) -> DataFrame:
        """``id, block`` that the anchors want to read; to probe, only the most promising.

        ``anchors`` has an array ``least``: what a positive (one element) or the negatives of each window have
        to reach, and besides it, for negatives, an array ``wanted`` of the positives' scores.
        """
        width, window = self.width, self.window
        of_window = "wanted" in anchors.columns
        kinds = {"id": pa.int64(), "block": pa.int32(), "most": pa.float64()}

        def choose(a: pa.Table, z: pa.Table) -> pa.Table:
            least, most = _bounds(_matrix(a["vec"], width), _matrix(z["lo"], width), _matrix(z["hi"], width))
            read = _holds(z, a["label"].to_numpy(), of_window)
            if of_window:
                ok = np.zeros_like(read)
                wanted, floor = (_longs(a[c], self_positives, -LONG) for c in ("wanted", "least"))
                known = np.diff(a["wanted"].combine_chunks().offsets.to_numpy())
                for i in range(self_positives):
                    p = wanted[:, i:i + 1].astype(float)
                    hair = 1e-9 * np.abs(p) + 1e-9  # products of longs are rounded in doubles
                    ok |= ((i < known)[:, None] & (100 * most >= window[0] * p - 100 * hair)
                           & (100 * least <= window[1] * p + 100 * hair)
                           & (most >= floor[:, i:i + 1].astype(float) * (1 - 1e-15) - 1e-9))
                read &= ok
            else:
                floor = _longs(a["least"], 1, -LONG).astype(float)
                last, first = a["last"].to_numpy()[:, None], z["first"].to_numpy()
                # of equal scores the smaller id counts, so a block of larger ones can't add any
                read &= ~(most < floor) & ~((most == floor) & (np.abs(floor) < EXACT) & (first > last))
            rows, cols = np.nonzero(read)
            rank = most[rows, cols]
            if probe:
                order = np.lexsort((cols, -rank, rows))
                row = rows[order]
                order = order[np.arange(len(row)) - np.searchsorted(row, row) < PROBED]
                rows, cols, rank = rows[order], cols[order], rank[order]
            return _table({"id": a["id"].to_numpy()[rows], "block": z["block"].to_numpy()[cols], "most": rank}, kinds)

        self_positives = self.positives
        deal = (F.pmod(F.xxhash64("id"), F.lit(self.anchor_groups)).cast("int"),
                F.pmod("block", F.lit(self.zone_groups)).cast("int"))
        found = pair_blocks(anchors, self.zones, self.anchor_groups, self.zone_groups, choose,
                            "id long, block int, most double", deal)
        if probe:
            best = W.partitionBy("id").orderBy(F.desc("most"), "block")
            found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= PROBED)
        return materialize(found.select("id", "block"), "chosen")

    def read(self, anchors: DataFrame, chosen: DataFrame) -> DataFrame:
        """``id, slot, other, score``: the best of each anchor in each block that it reads."""
        width, window, positives, negatives = self.width, self.window, self.positives, self.negatives
        of_window = "wanted" in anchors.columns
        kinds = {"id": pa.int64(), "slot": pa.int32(), "other": pa.int64(), "score": pa.int64()}
        none = _table({c: np.empty(0, np.int64) for c in kinds}, kinds)

        def best(a: pa.Table, c: pa.Table) -> pa.Table:
            if not a.num_rows or not c.num_rows:
                return none
            ids, others = a["id"].to_numpy(), c["id"].to_numpy()
            score = _scores(_matrix(a["vec"], width), _matrix(c["vec"], width))
            alike = a["label"].to_numpy()[:, None] == c["label"].to_numpy()
            parts = []
            if of_window:
                wanted, floor = (_longs(a[n], positives, -LONG) for n in ("wanted", "least"))
                known = np.diff(a["wanted"].combine_chunks().offsets.to_numpy())
                for i in range(positives):
                    ok = (~alike & (i < known)[:, None] & _in_window(score, wanted[:, i:i + 1], *window)
                          & (score >= floor[:, i:i + 1]))
                    parts.append((i, *_top(score, others, ok, negatives)))
            else:
                ok = alike & (ids[:, None] != others) & (score >= _longs(a["least"], 1, -LONG))
                parts.append((0, *_top(score, others, ok, positives)))
            return pa.concat_tables([_table({"id": ids[rows], "slot": np.full(len(rows), i), "other": others[cols],
                                             "score": score[rows, cols]}, kinds) for i, rows, cols in parts])

        left = anchors.join(chosen, "id")
        groups = left.select("block", "grp").distinct()  # anchors of one group meet a block together
        right = self.blocks.join(groups, "block")
        # both sides come from one frame; new names for the same columns keep them apart
        right = right.select(*[F.col(c).alias(c) for c in ("block", "grp", "id", "label", "vec")])
        return left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp")).applyInArrow(
            best, "id long, slot int, other long, score long")

    def found(self, anchors: DataFrame, k: int, limits) -> DataFrame:
        """``id, slot, other, score, n``: the k best of all blocks, in two rounds of reading.

        ``limits`` adds to the anchors what the second round has to reach, given the finds of the first.
        """
        def first(df: DataFrame) -> DataFrame:
            order = W.partitionBy("id", "slot").orderBy(F.desc("score"), "other")
            return df.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)

        probed = self.chosen(anchors, True)
        some = materialize(first(self.read(anchors, probed)), "some")
        limited = materialize(limits(anchors, some), "limited")
        rest = materialize(self.chosen(limited, False).join(probed, ["id", "block"], "left_anti"), "rest")
        return materialize(first(some.drop("n").unionByName(self.read(limited, rest))), "found")


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_col: str = "id", vector_col: str = "vec",
                   label_col: str = "label", scale: float = 1.0, positives: int = 5, negatives: int = 3,
                   window: tuple[int, int] = (50, 95), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become floor(scale * x); a score is the inner product with the anchor, a shorter vector
    ends in zeros. An anchor (``is_anchor``, a predicate on ``id``) has as positives the ``positives`` other rows
    of its label with the highest scores; for each, the ``negatives`` rows of other labels come first whose
    score times 100 lies between ``window`` times the positive's score. Ties go to the smaller id; where there
    are fewer, all are returned. Rows without an id, label or vector, or with a null or non-finite
    component, take no part; of several rows under one id the one of smallest label and vector counts. Scores
    beyond a long become the largest long of their sign. Other columns are not read; no rows give none.
    """
    known = materialize(_known(vectors, id_col, vector_col, label_col, scale), "vectors")
    rows, width = (v or 0 for v in known.agg(F.count("*"), F.max(F.size("vec"))).first())
    width = max(1, width)
    parts = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # smaller blocks where there would be fewer than tasks to run
    blocks = _ordered(known, width, rows, max(1, min(block_rows, max(256, -(-rows // parts)))))
    zones = materialize(_zone_maps(blocks, width), "zones")
    anchors = materialize(blocks.where(is_anchor).withColumnRenamed("block", "grp"), "anchors")
    search = _Search(blocks, zones, anchors, width, positives, negatives, window)

    def last_positive(those: DataFrame, some: DataFrame) -> DataFrame:
        full = some.where(F.col("n") == positives).select("id", F.array("score").alias("reach"), F.col("other").alias("end"))
        return (those.drop("least", "last").join(full, "id", "left").withColumn("least", F.coalesce("reach", F.array(F.lit(-LONG))))
                .withColumn("last", F.coalesce("end", F.lit(LONG))).drop("reach", "end"))

    plain = anchors.withColumn("least", F.array(F.lit(-LONG))).withColumn("last", F.lit(LONG))
    good = search.found(plain, positives, last_positive)
    slots = good.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("n", "score", "other"))).alias("p"))
    wanting = materialize(anchors.join(slots, "id").withColumn("wanted", F.col("p.score"))
                          .withColumn("least", F.transform("p", lambda _: F.lit(-LONG))).drop("p"), "wanting")

    def last_negatives(those: DataFrame, some: DataFrame) -> DataFrame:
        full = (some.where(F.col("n") == negatives).groupBy("id")
                .agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("reach")))
        reached = F.transform("least", lambda v, i: F.coalesce(F.element_at("reach", i), v))
        return those.join(full, "id", "left").withColumn("least", reached).drop("reach")

    bad = search.found(wanting, negatives, last_negatives)
    chosen = good.select("id", (F.col("n") - 1).alias("slot"), F.col("other").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    made = materialize(bad.join(chosen, ["id", "slot"]).select(
        F.col("id").alias("anchor_id"), "positive_id", F.col("n").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")), "negatives")
    for used in (known, blocks, zones, anchors, wanting):
        forget(used)
    return made
