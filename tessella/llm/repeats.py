"""Exact substring deduplication by a hash-compared suffix sort.

Every byte goes that lies in a string of ``length`` bytes which also starts somewhere else. Suffixes
are sorted only where they can matter:

* Each window of ``length`` bytes is filed under its anchor, the gram of least hash within it, so equal
  windows share anchor and offset. Windows that follow each other under one anchor are a run with one
  context: the bytes of all its windows. Grams that occur once drop out.
* Runs with one context are one class, repeated as a whole if it occurs twice.
* The contexts of an anchor meet in one task, where the suffixes at all starts of a run are sorted by
  mergesort. Prefix polynomial hashes and a binary search give the common extension of two suffixes, so
  a comparison takes logarithmic time. Neighbours are then compared byte by byte; a group in which a
  hash has collided is sorted anew by its bytes.
* An anchor with very many contexts (a line that half of all documents have) is filed anew by the bytes
  that blocks of 76 windows have in common, then of 16, 4 and one. What has the same bytes becomes one
  class each time, so only the edges of what is shared go on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tessella.llm.common import forget, materialize, mix64, struct_array

#: bytes of an anchor
GRAM = 50
#: bytes of text whose windows are hashed at a time; positions take this many bits
CHUNK_BITS = 20
#: contexts of one group that are sorted in one task, and suffixes that are sorted at a time
GROUP_CONTEXTS, TASK_SUFFIXES = 4096, 1 << 18
#: bytes of contexts in one group of a sort
BUCKET_BYTES = 8 << 20
#: windows per block when an anchor is filed anew, round by round
BLOCK_WINDOWS = (76, 16, 4, 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint64(1)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=1)
def _inverse() -> np.uint64:
    return np.uint64(pow(int(_BASE), -1, 1 << 64))


class Hashes:
    """Prefix polynomial hashes modulo 2^64 of some bytes: the hash of any range in constant time.

    Ranges of fewer than 1,024 bytes can't be made to collide by the known construction for this modulus.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        power = np.empty(n + 1, np.uint64)
        power[0], power[1:] = _ONE, _BASE
        np.multiply.accumulate(power, out=power)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_byte_values()[data] * power[:n], out=self.prefix[1:])
        power[1:] = _inverse()
        self.shift = np.multiply.accumulate(power, out=power)

    def of(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + size] - self.prefix[start]) * self.shift[start]


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` that follow each other."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    return np.minimum(after[:starts], before[width - 1:width - 1 + starts])


def text_class(data: bytes) -> tuple[int, int]:
    """Two longs that stand for a text."""
    digest = xxhash.xxh3_128_digest(data)
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _runs(parts: list[tuple[bytes, int, int, int]], length: int) -> dict[str, np.ndarray]:
    """The runs of windows under one anchor in parts ``bytes, offset, class, class`` of texts."""
    data = np.frombuffer(b"".join(p[0] for p in parts), np.uint8)
    sizes = np.array([len(p[0]) for p in parts])
    ends = np.cumsum(sizes)
    hashes = Hashes(data)
    grams = mix64(hashes.of(np.arange(len(data) - GRAM + 1), GRAM))
    low = np.uint64((1 << CHUNK_BITS + 1) - 1)
    # ties of the upper bits go to the gram that comes first
    least = _window_minima((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
    owner = np.repeat(np.arange(len(parts)), sizes)[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + length <= ends[owner])
    anchor, owner = (least[start] & low).astype(np.int64), owner[start]
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
    last = np.append(first[1:], len(start)) - 1
    lo, hi, at, owner = start[first], start[last], anchor[first], owner[first]
    offset = np.array([p[1] for p in parts])[owner] - (ends - sizes)[owner]
    c1, c2 = (np.array([p[i] for p in parts], np.int64)[owner] for i in (2, 3))
    back, more = at - lo, hi - lo
    shape = mix64(((back << 16) + more + 1).astype(np.uint64))
    place = mix64(c1.view(np.uint64) ^ mix64(c2.view(np.uint64) + (lo + offset).astype(np.uint64)))
    return {"anchor": grams[at].view(np.int64), "ctx": mix64(hashes.of(lo, hi + length - lo) ^ shape).view(np.int64),
            "occ": place.view(np.int64), "c1": c1, "c2": c2, "at": (at + offset).astype(np.int32),
            "lo": (back - more).astype(np.int16), "hi": back.astype(np.int16)}


RUN = "anchor long, ctx long, occ long, c1 long, c2 long, at int, lo short, hi short"


def _occurrences(texts: DataFrame, length: int) -> DataFrame:
    """The runs of every text; a text that a task has seen before is left out.

    ``at`` is the place of the anchor; its windows start ``lo`` to ``hi`` bytes before it.
    """
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        parts, size = [], 0

        def made() -> pa.RecordBatch:
            columns = _runs(parts, length)
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], list(columns))

        for batch in batches:
            for text in batch["text"]:
                data = text.as_py()
                if len(data) < length or (mark := text_class(data)) in seen:
                    continue
                seen.add(mark)
                step = (1 << CHUNK_BITS) - length
                for start in range(0, len(data) - length + 1, step):
                    part = data[start:start + step + length - 1]
                    if size + len(part) > 1 << CHUNK_BITS and parts:
                        yield made()
                        parts, size = [], 0
                    parts.append((part, start, *mark))
                    size += len(part)
        if parts:
            yield made()

    return texts.mapInArrow(found, RUN)


def _less(data: np.ndarray, hashes: Hashes, x: np.ndarray, y: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the window at x comes before that at y, and whether the two are equal by their hashes."""
    same = hashes.of(x, length) == hashes.of(y, length)
    less = np.zeros(len(x), bool)
    open_ = np.flatnonzero(~same)
    x, y = x[open_], y[open_]
    low, high = np.zeros(len(x), np.int64), np.full(len(x), length - 1)
    while (low < high).any():  # bytes in common
        middle = (low + high + 1) >> 1
        equal = hashes.of(x, middle) == hashes.of(y, middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    less[open_] = data[x + low] < data[y + low]
    return less, same


def _merge_sort(data: np.ndarray, hashes: Hashes, at: np.ndarray, first: np.ndarray, size: np.ndarray,
                length: int) -> np.ndarray:
    """Sort the suffixes ``at`` within groups (``first`` index and ``size`` of each) by their first bytes.

    Runs of one, two, four ... are merged pairwise, all groups at once: a suffix finds its place in the
    other run by binary search.
    """
    group = np.repeat(np.arange(len(size)), size)
    local = np.arange(len(at)) - first[group]
    width, most = 1, int(size.max(initial=0))
    while width < most:
        own = local // width
        other = (own ^ 1) * width
        left = np.minimum(other, size[group])
        low, high = first[group] + left, first[group] + np.minimum(other + width, size[group])
        begin = low.copy()
        right_run = (own & 1).astype(bool)
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) >> 1
            less, same = _less(data, hashes, at[middle], at[active], length)
            up = less | (same & right_run[active])  # equal ones keep their order
            low[active] = np.where(up, middle + 1, low[active])
            high[active] = np.where(up, high[active], middle)
            active = active[low[active] < high[active]]
        place = first[group] + (own >> 1) * 2 * width + (local - own * width) + (low - begin)
        clash = np.bincount(place, minlength=len(at)) != 1
        if clash.any():  # hashes that lied: the group stays as it is, which is seen later
            place = np.where(np.isin(group, group[clash]), np.arange(len(at)), place)
        merged = np.empty_like(at)
        merged[place] = at
        at = merged
        width *= 2
    return at


def _compared(data: np.ndarray, x: np.ndarray, y: np.ndarray, length: int) -> np.ndarray:
    """-1, 0 or 1 as the bytes of the window at x come before, equal or come after those at y."""
    out = np.zeros(len(x), np.int8)
    left = np.arange(len(x))
    eights = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    for step in [*range(0, length - 8, 8), length - 8]:
        a, b = eights[x[left] + step], eights[y[left] + step]
        out[left] = (a > b).astype(np.int8) - (a < b)
        left = left[a == b]
    return out


def repeated_starts(data: np.ndarray, at: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Whether the window at each place equals another one of its group."""
    order = np.argsort(group, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(group[order]) != 0)) if len(order) else order
    size = np.diff(np.append(first, len(order)))
    keep = np.repeat(size > 1, size)
    order, size = order[keep], size[size > 1]
    first = np.cumsum(size) - size
    hit = np.zeros(len(at), bool)
    if not len(order):
        return hit
    # suffixes are told apart by their place, so the index of each is looked up after the sort
    places = _merge_sort(data, Hashes(data), at[order], first, size, length)
    owner = np.repeat(np.arange(len(size)), size)
    inner = owner[1:] == owner[:-1]
    sign = np.where(inner, _compared(data, places[:-1], places[1:], length), -1)
    collided = np.unique(owner[1:][sign > 0])
    for g in collided:  # the hashes lied: sort by the bytes themselves
        span = slice(first[g], first[g] + size[g])
        places[span] = sorted(places[span], key=lambda p: data[p:p + length].tobytes())
    if len(collided):
        sign = np.where(inner, _compared(data, places[:-1], places[1:], length), -1)
    equal = np.zeros(len(places), bool)
    equal[1:] |= sign == 0
    equal[:-1] |= sign == 0
    index = np.argsort(at, kind="stable")
    hit[index[np.searchsorted(at[index], places[equal])]] = True
    return hit


def _sorted_contexts(table: pa.Table, length: int) -> pa.Table:
    """``anchor, ctx, lo, hi`` of the windows of a bucket's open contexts that repeat."""
    table = table.take(pa.array(np.argsort(table["key"].to_numpy(), kind="stable")))
    key, lo, hi = (table[c].to_numpy().astype(np.int64) for c in ("key", "lo", "hi"))
    is_open = table["open"].to_numpy()
    starts = hi - lo + 1
    same = np.append(True, key[1:] != key[:-1]) if len(key) else np.empty(0, bool)
    # groups are sorted together up to a number of suffixes
    upto, cuts = np.cumsum(starts), [0]
    for c in np.flatnonzero(same)[1:]:
        if upto[c - 1] - (upto[cuts[-1] - 1] if cuts[-1] else 0) >= TASK_SUFFIXES:
            cuts.append(int(c))
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(key)]):
        if a == b:
            continue
        data = np.frombuffer(b"".join(table["bytes"].slice(a, b - a).to_pylist()) + bytes(8), np.uint8)
        size = starts[a:b] + length - 1
        owner = np.repeat(np.arange(b - a), starts[a:b])
        step = np.arange(len(owner)) - (np.cumsum(starts[a:b]) - starts[a:b])[owner]
        at = (np.cumsum(size) - size)[owner] + step
        back = hi[a:b][owner] - step
        group = (np.cumsum(same[a:b])[owner] << 16) + back
        hit = repeated_starts(data, at, group, length) & is_open[a:b][owner]
        begin = np.flatnonzero(hit & ((step == 0) | ~np.append(False, hit[:-1])))
        end = np.flatnonzero(hit & (np.append(step[1:] == 0, True) | ~np.append(hit[1:], False)))
        out.append((owner[begin] + a, back[end], back[begin]))
    rows = np.concatenate([o[0] for o in out]) if out else np.empty(0, np.int64)
    found = table.select(["anchor", "ctx"]).take(pa.array(rows))
    for name, i in (("lo", 1), ("hi", 2)):
        found = found.append_column(name, pa.array(
            np.concatenate([o[i] for o in out]).astype(np.int16) if out else np.empty(0, np.int16)))
    return found


def _distinct_texts(texts: DataFrame) -> DataFrame:
    """``c1, c2, text``: the texts of each task, once."""
    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            marks, keep = [], []
            for i, text in enumerate(batch["text"]):
                mark = text_class(text.as_py())
                if mark not in seen:
                    seen.add(mark)
                    marks.append(mark)
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([m[0] for m in marks], pa.int64()), pa.array([m[1] for m in marks], pa.int64()),
                 batch["text"].take(pa.array(keep, pa.int64()))], ["c1", "c2", "text"])

    return texts.mapInArrow(once, "c1 long, c2 long, text binary")


def _with_texts(texts: DataFrame, wanted: DataFrame, fields: list[str]) -> DataFrame:
    """``c1, c2, text, rows``: each text that rows are wanted of, once, with its rows."""
    rows = wanted.groupBy("c1", "c2").agg(F.collect_list(F.struct(*fields)).alias("rows"))
    return _distinct_texts(texts).join(rows, ["c1", "c2"]).dropDuplicates(["c1", "c2"])


def _cut_out(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The wanted contexts with their bytes."""
    names = ["key", "anchor", "ctx", "lo", "hi", "open", "n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text, rows = batch["text"][i].as_py(), batch["rows"][i].values
                at, lo, hi = (rows.field(c).to_numpy().astype(np.int64) for c in ("at", "lo", "hi"))
                parts = [text[a:b] for a, b in zip((at - hi).tolist(), (at - lo + length).tolist())]
                yield pa.RecordBatch.from_arrays([*(rows.field(c) for c in names), pa.array(parts, pa.binary())],
                                                 [*names, "bytes"])

    return (_with_texts(texts, wanted, [*names, "at"])
            .mapInArrow(cut, "key long, anchor long, ctx long, lo short, hi short, open boolean, n long, bytes binary"))


def _filed_anew(contexts: DataFrame, width: int, length: int) -> DataFrame:
    """The contexts, cut into blocks of ``width`` windows by their offset from the anchor.

    The key of a block is the hash of the bytes that all its windows have, ``whole`` that of all its bytes.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*[pa.int64()] * 4, pa.int16(), pa.int16(), pa.bool_(), pa.binary()]
        names = ["key", "whole", "anchor", "ctx", "lo", "hi", "open", "bytes"]
        for batch in batches:
            out = []
            for anchor, ctx, low, high, is_open, data in zip(*(batch[c].to_pylist() for c in names[2:])):
                for block in range(low // width, high // width + 1):
                    # the windows from lo to hi bytes before the anchor, which is high bytes into the context
                    lo, hi = max(low, block * width), min(high, block * width + width - 1)
                    part = data[high - hi:high - lo + length]
                    seed = (anchor + block) & 0xFFFFFFFFFFFFFFFF
                    start = hi - block * width
                    key = xxhash.xxh3_64_intdigest(part[start:start - width + 1 + length], seed=seed)
                    whole = xxhash.xxh3_64_intdigest(part, seed=seed)
                    out.append((key - (1 << 63), whole - (1 << 63), anchor, ctx, lo, hi, is_open, part))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 8, kinds)], names)

    return contexts.select("anchor", "ctx", "lo", "hi", "open", "bytes").mapInArrow(
        cut, "key long, whole long, anchor long, ctx long, lo short, hi short, open boolean, bytes binary")


def _partly_repeated(texts: DataFrame, contexts: DataFrame, length: int, most: int) -> list[DataFrame]:
    """``anchor, ctx, lo, hi``: repeated windows of contexts whose anchor has several of them."""
    def met(todo: DataFrame) -> DataFrame:
        """Contexts that share their key with others, not all of them known to be repeated."""
        groups = materialize(todo.groupBy("anchor", "key").agg(F.count("*").alias("n"), F.max("open").alias("o"))
                             .where("n > 1 and o").select("anchor", "key", "n"), "groups")
        return todo.join(groups, ["anchor", "key"])

    found, ranges = [], ["anchor", "ctx", "lo", "hi"]
    todo = materialize(_cut_out(texts, met(contexts.withColumn("key", F.col("anchor"))), length), "contexts")
    sort = [todo.where(F.col("n") <= most)]
    for width in BLOCK_WINDOWS:
        many = todo.where(F.col("n") > most)
        if many.isEmpty():
            break
        blocks = materialize(_filed_anew(many, width, length), "blocks")
        same = ["anchor", "key", "whole", "lo", "hi"]
        classes = materialize(blocks.groupBy(*same).agg(F.count("*").alias("c"), F.min("ctx").alias("rep")), "classes")
        blocks = blocks.join(classes, same)
        found.append(blocks.where("open and c > 1").select(*ranges))
        blocks = blocks.where("ctx = rep").withColumn("open", F.col("open") & (F.col("c") == 1)).drop("c", "rep", "whole")
        todo = materialize(met(blocks), "contexts")
        sort.append(todo.where(F.col("n") <= most))
    wanted = sort[0]
    for more in sort[1:]:
        wanted = wanted.unionByName(more)
    # groups are dealt to buckets of bounded size, whole
    held = wanted.agg(F.sum(F.col("hi") - F.col("lo") + length)).first()[0] or 0
    cores = texts.sparkSession.sparkContext.defaultParallelism
    buckets = max(cores, -(-held // BUCKET_BYTES))
    found.append(wanted.drop("n").groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
                 .applyInArrow(lambda t: _sorted_contexts(t, length), "anchor long, ctx long, lo short, hi short"))
    return found


def _kept(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """``c1, c2, n_removed, n_spans, kept_sha256`` of texts with some ranges ``begin, end`` to remove."""
    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for c1, c2, text, rows in zip(*(batch[c] for c in ("c1", "c2", "text", "rows"))):
                text = text.as_buffer()
                begin, end = (rows.values.field(c).to_numpy().astype(np.int64) for c in ("begin", "end"))
                order = np.argsort(begin, kind="stable")
                begin, end = begin[order], np.maximum.accumulate(end[order])
                new = np.append(True, begin[1:] > end[:-1])  # touching ranges are one
                first = np.flatnonzero(new)
                begin, end = begin[first], end[np.append(first[1:], len(end)) - 1]
                kept, upto = hashlib.sha256(), 0
                for a, b in zip(begin.tolist(), end.tolist()):
                    kept.update(memoryview(text)[upto:a])
                    upto = b
                kept.update(memoryview(text)[upto:])
                out.append((c1.as_py(), c2.as_py(), int((end - begin).sum()), len(begin), kept.hexdigest()))
            kinds = [*[pa.int64()] * 4, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 5, kinds)],
                                             ["c1", "c2", "n_removed", "n_spans", "kept_sha256"])

    return (_with_texts(texts, ranges, ["begin", "end"])
            .mapInArrow(rest, "c1 long, c2 long, n_removed long, n_spans long, kept_sha256 string"))


def _profile(text: Column) -> Column:
    @F.arrow_udf("struct<c1 long, c2 long, n_bytes long, whole string>")
    def profile(texts: pa.Array) -> pa.Array:
        data = [t.as_py() for t in texts]
        marks = [text_class(d) for d in data]
        return struct_array({"c1": ([m[0] for m in marks], pa.int64()), "c2": ([m[1] for m in marks], pa.int64()),
                             "n_bytes": (list(map(len, data)), pa.int64()),
                             "whole": ([hashlib.sha256(d).hexdigest() for d in data], pa.string())})
    return profile(text)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200,
                   group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every row.

    Texts are UTF-8 bytes, a null text is empty. A byte is removed if a string of ``length`` bytes over it
    also starts anywhere else: in another row, or elsewhere in its own (the two may overlap). Strings
    don't cross rows and are judged on the input. Removed bytes that touch are one span. Rows that
    repeat, ids included, are documents of their own, so they remove each other. Texts shorter than
    ``length`` lose nothing. Other columns are not read; no rows give none. Texts and runs of windows are
    taken for equal when 128 bits of hashes agree; windows that are sorted are compared byte by byte.
    """
    if not 2 * GRAM <= length < 1 << 9:
        raise ValueError(f"length has to lie between {2 * GRAM} and {(1 << 9) - 1}")
    data = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    texts = docs.select(data.alias("text"))
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), _profile(data).alias("p")).select("id", "p.*"),
                       "rows")
    every = materialize(_occurrences(texts, length), "runs")
    # a gram that is in one place only stands for no repeated window
    shared = materialize(every.groupBy("anchor").agg(F.min("occ").alias("a"), F.max("occ").alias("b"))
                         .where("a <> b").select("anchor"), "anchors")
    runs = materialize(every.join(shared, "anchor"), "shared")
    forget(every)
    place = F.struct("occ", "c1", "c2", "at", "lo", "hi")
    classes = materialize(runs.groupBy("anchor", "ctx").agg(F.min(place).alias("p"), F.max("occ").alias("last"))
                          .select("anchor", "ctx", "p.*", (F.col("p.occ") == F.col("last")).alias("open")), "classes")
    whole = classes.where("not open").select("anchor", "ctx", "lo", "hi")
    parts = _partly_repeated(texts, classes.drop("occ"), length, group_contexts)
    for part in parts:
        whole = whole.unionByName(part)
    windows = materialize(whole.groupBy("anchor", "ctx").agg(F.collect_list(F.struct("lo", "hi")).alias("w")), "windows")
    # a text with a copy goes as a whole
    copies = materialize(rows.where(F.col("n_bytes") >= length).groupBy("c1", "c2").agg(
        F.count("*").alias("copies")).where("copies > 1"), "copies")
    ranges = (runs.select("anchor", "ctx", "c1", "c2", "at")
              .join(windows, ["anchor", "ctx"]).join(copies, ["c1", "c2"], "left_anti")
              .select("c1", "c2", "at", F.explode("w").alias("w"))
              .select("c1", "c2", (F.col("at") - F.col("w.hi")).alias("begin"),
                      (F.col("at") - F.col("w.lo") + length).alias("end")))
    judged = materialize(_kept(texts, ranges).unionByName(
        copies.join(rows.select("c1", "c2", "n_bytes").distinct(), ["c1", "c2"]).select(
            "c1", "c2", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
            F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"))), "judged")
    for table in (runs, classes, windows):
        forget(table)
    none = F.lit(0).cast("long")
    return rows.join(judged, ["c1", "c2"], "left").select(
        "id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"))
