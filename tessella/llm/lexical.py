"""Ranked lexical search over bags of terms: equal bags are scored once.

Only terms of the items can score, so every document is restricted to that vocabulary: its bag is the
ids of the terms it holds and how often it holds them. Documents with equal bags and the same length
factor m have equal scores for every item; they are found by a hash of the bag, told apart by its bytes, and
form one class. Each class is scored once for all items, an item's best classes are chosen by score and
smallest doc_id, and only those are expanded to their members, in ascending order of doc_id.

Items are searched in blocks whose vocabulary has a bounded size, so what is broadcast doesn't grow.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.llm.common import forget, materialize

#: a term in UTF-8, after A-Z have become a-z; all code points beyond ASCII belong to terms
TERM, OTHER = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: bytes of one text that are cut into terms at a time
TEXT_BYTES = 1 << 22
#: pairs of item and term of a block of items: the bound of what is broadcast and of what is sent to the driver
BLOCK_PAIRS = 200_000
#: cells of one table of scores, and candidates kept before they are thinned out
TILE_CELLS, KEPT_ROWS = 1 << 20, 1 << 19
#: parts of a class that are cut down to the k first members apart
CLASS_PARTS = 16
LAST = (1 << 63) - 1


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time."""
    start = 0
    while start < len(data):
        stop = start + TEXT_BYTES
        if stop < len(data):  # a term isn't cut
            found = OTHER.search(data, stop)
            stop = found.start() if found else len(data)
        yield TERM.findall(data[start:stop].lower())
        start = stop


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item, term``: each term of an item once."""
    @F.arrow_udf("array<binary>")
    def distinct(texts: pa.Array) -> pa.Array:
        return pa.array([sorted({t for part in terms(text.as_py()) for t in part}) for text in texts],
                        pa.list_(pa.binary()))

    named = items.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    return (named.select(F.col(f"`{id_col}`").cast("long").alias("item"),
                         F.explode(distinct(F.col(f"`{text_col}`").cast("binary"))).alias("term")).distinct())


@dataclass
class Block:
    """A block of items: its vocabulary, and the items of each term as one run of ``member``."""

    vocabulary: dict[bytes, int]
    items: np.ndarray
    start: np.ndarray
    member: np.ndarray

    @classmethod
    def of(cls, pairs: pa.Table) -> Block:
        words = sorted(set(pairs["term"].to_pylist()))
        vocabulary = {w: i for i, w in enumerate(words)}
        items, member = np.unique(pairs["item"].to_numpy(), return_inverse=True)
        term = np.fromiter(map(vocabulary.__getitem__, pairs["term"].to_pylist()), np.int64, len(member))
        order = np.lexsort((member, term))
        return cls(vocabulary, items, np.searchsorted(term[order], np.arange(len(words) + 1)), member[order])


def _bags(docs: DataFrame, shared) -> DataFrame:
    """``id, n, bag`` of documents with a term: all terms counted, and those of the vocabulary in order."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.vocabulary
        for batch in batches:
            ids, sizes, bags = [], [], []
            for i, text in zip(batch["id"], batch["text"]):
                n, held = 0, Counter()
                for part in terms(text.as_py()):
                    n += len(part)
                    held.update(map(known.get, part))
                if n:
                    held.pop(None, None)
                    bag = np.array(sorted(held.items()), np.int64).reshape(-1, 2)
                    ids.append(i.as_py())
                    sizes.append(n)
                    bags.append(bag.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                                              pa.array(bags, pa.binary())], ["id", "n", "bag"])

    return docs.mapInArrow(count, "id long, n long, bag binary")


def _entries(bags: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and count of every entry of some bags."""
    flat = np.frombuffer(b"".join(bags), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(bags)), [len(b) // 8 for b in bags]), flat[:, 0], flat[:, 1]


def _document_counts(bags: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term of the vocabulary."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_entries(batch["bag"].to_pylist())[1], minlength=size)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], ["term", "n"])

    found = (bags.select("bag").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
             .toArrow())  # at most one row per term of the block
    counts = np.zeros(size, np.int64)
    counts[found["term"].to_numpy()] = found["n"].to_numpy()
    return counts


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _thinned(rows: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The k first rows of each item: ``item, score, first id, ...`` by score and first id."""
    order = np.lexsort((*rows[:2:-1], rows[2], -rows[1], rows[0]))
    item = rows[0][order]
    order = order[np.arange(len(item)) - np.searchsorted(item, item) < k]
    return [r[order] for r in rows]


def _best_classes(classes: DataFrame, shared, weight, k: int) -> DataFrame:
    """``item, score, first, h1, h2, m``: each task's best classes per item."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = shared.value, weight.value
        n_items = len(block.items)
        best = [np.empty(0, np.int64)] * 6
        floor = np.zeros(n_items, np.int64)
        most = int(weights.max(initial=0)) * 10 ** 6 * max(1, int(np.bincount(block.member).max(initial=0)))
        step = max(1, TILE_CELLS // max(1, n_items))
        for batch in batches:
            columns = [batch[c].to_numpy() for c in ("first", "h1", "h2", "m")]
            bags = batch["bag"].to_pylist()
            for a in range(0, len(bags), step):
                row, term, tf = _entries(bags[a:a + step])
                m = columns[3][a:a + step]
                part = weights[term] * ((10 ** 9 * tf) // (1000 * tf + 20 * m[row]))
                # every entry counts for all items that have its term
                size = block.start[term + 1] - block.start[term]
                within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                cell = np.repeat(row * n_items, size) + block.member[np.repeat(block.start[term], size) + within]
                if most < 1 << 53:  # doubles hold the sums
                    total = np.bincount(cell, np.repeat(part, size), len(m) * n_items).astype(np.int64)
                else:
                    total = np.zeros(len(m) * n_items, np.int64)
                    np.add.at(total, cell, np.repeat(part, size))
                total = total.reshape(len(m), n_items)
                at, item = np.nonzero((total >= floor) & (total > 0))
                found = [item, total[at, item], *(c[a:a + step][at] for c in columns)]
                best = [np.concatenate(x) for x in zip(best, found)]
                if len(best[0]) > max(KEPT_ROWS, 4 * k * n_items):
                    best = _thinned(best, k)
                    held = np.bincount(best[0], minlength=n_items)
                    low = np.full(n_items, LAST)
                    np.minimum.at(low, best[0], best[1])
                    floor = np.where(held >= k, low, 0)
        best = _thinned(best, k)
        best[0] = block.items[best[0]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in best], ["item", "score", "first", "h1", "h2", "m"])

    return classes.mapInArrow(score, "item long, score long, first long, h1 long, h2 long, m long")


def _marks(bag: str) -> list[Column]:
    """Two hashes of a bag."""
    return [F.xxhash64(bag).alias("h1"), F.xxhash64(F.lit(1), bag).alias("h2")]


def _first(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str) -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def _search_block(docs: DataFrame, pairs: pa.Table, k: int) -> DataFrame:
    spark = docs.sparkSession
    block = Block.of(pairs)
    shared = spark.sparkContext.broadcast(block)  # BLOCK_PAIRS or one item
    bags = materialize(_bags(docs, shared).select("*", *_marks("bag")), "bags")
    total = bags.agg(F.count("*"), F.sum("n")).first()
    documents, length = total[0], total[1] or 1
    weight = spark.sparkContext.broadcast(np.array(
        [term_weight(documents, int(n)) for n in _document_counts(bags, len(block.vocabulary))], np.int64))
    m = F.expr(f"100 - 50 + (50 * n * {documents}L) div {length}L")
    held = bags.where("octet_length(bag) > 0").select("id", "h1", "h2", m.alias("m"), "bag")
    same = ["h1", "h2", "m", "bag"]  # the bytes tell classes apart whose hashes agree
    classes = materialize(held.groupBy(*same).agg(F.min(F.coalesce("id", F.lit(LAST))).alias("first")), "classes")
    top = materialize(_first(_best_classes(classes, shared, weight, k), ["item"],
                             [F.desc("score"), F.asc("first"), F.asc("h1"), F.asc("h2"), F.asc("m")], k, "place")
                      .join(classes, ["h1", "h2", "m", "first"]), "top")
    # a class of very many documents is cut down in parts before it meets in one place
    part = F.explode(F.sequence(F.lit(0), F.lit(CLASS_PARTS - 1)))
    chosen = materialize(top.select(*same).distinct().withColumn("part", part), "chosen")
    members = held.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(CLASS_PARTS))).join(chosen, [*same, "part"])
    by_id = [F.asc_nulls_last("id")]
    members = _first(_first(members, [*same, "part"], by_id, k, "nth"), same, by_id, k, "nth")
    found = _first(top.join(members, same), ["item"], [F.desc("score"), F.asc_nulls_last("id")], k, "rank")
    made = materialize(found.select("item", F.col("rank").cast("int").alias("rank"), "id", "score"), "ranked")
    for used in (bags, classes, top, chosen):
        forget(used)
    return made


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item, rank, id, score``: each item's k documents of highest score above 0.

    Terms are runs of ASCII letters and digits and of code points beyond ASCII, A-Z in lower case. Every
    row of ``docs`` is a document, repeated rows included; null texts have no terms and don't count. Equal
    scores are ranked by ascending id, rows without an id last. Rows of items without an id or text are left
    out; rows with one item id are one item with the terms of all. Other columns are not read. Without
    documents or items there are no rows. Items are searched in blocks of about ``block_pairs`` terms in
    all, or one item that has more; documents are read once per block.
    """
    docs = (docs.where(F.col(f"`{text_col}`").isNotNull())
            .select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text")))
    pairs = materialize(_item_terms(items, item_col, item_text_col), "item-terms")
    blocks = max(1, -(-pairs.count() // block_pairs))
    found = [_search_block(docs, pairs.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).toArrow(), k)
             for b in range(blocks)]
    forget(pairs)
    made = found[0]
    for more in found[1:]:
        made = made.union(more)
    return made
