"""Jaccard join of documents on word n-grams by vertical partitioning.

The n-grams of a document are hashed, and the hashes, in numeric order, are the global n-gram
order. It is cut into fragments: equal ranges whose number depends on the size class of a set. Two
sets that link differ in few n-grams, fewer than there are fragments, so they agree wholly in at
least one of them: documents meet only where a whole segment is the same. There are more fragments
than that takes, so linked sets agree in several segments and each set may leave out its most
frequent ones: a passage that many documents share brings nobody together. Pairs that met are counted exactly: each fragment gives a
partial overlap, computed apart, and the overlaps are summed per pair.

Groups that met are not paired up. Members are first tested against one of them, links are closed
to components, and only members that are still in different components are tested among themselves.
Components are exact: every link between different sets is either tested or already implied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.llm.common import drop_tables, forget, materialize, mix64
from tessella.llm.graph import components

#: size classes grow by this factor; a set also joins the class below when it can link into it
CLASS_RATIO = 1.25
#: fragments beyond those that the largest difference needs, as a share of them
SLACK = 0.125
#: bytes of the texts that are hashed together
GROUP_BYTES = 1 << 18
#: signatures that a task hands over at a time
BATCH_SIGNATURES = 1 << 16
#: low bits of a signature that hold its size class
CLASS_BITS = 7
#: fragments of the exact count
FRAGMENTS = 8
#: n-grams and sets of a block, and cells of one step of the count between two blocks
BLOCK_GRAMS, BLOCK_SETS, STEP_CELLS = 1 << 18, 1 << 10, 1 << 21
#: members of a group up to which its open pairs are tested by themselves; larger groups meet in blocks
SMALL_GROUP = 32
#: members of groups that are looked through together
BUCKET_MEMBERS = 256
#: ranges of a sketch are powers of two: 2 to 4 n-grams in each, and so many ranges at least
SKETCH_GRAMS, SKETCH_BITS = 4, 6


class Sets(NamedTuple):
    """Sorted distinct n-gram hashes of several texts, one after the other; a text's lie between two offsets."""

    grams: np.ndarray
    offsets: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(self.offsets)

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over each set of a number per n-gram, modulo 2 ** 64; empty sets have 0."""
        total = np.append(np.uint64(0), np.cumsum(values, dtype=np.uint64))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def where(self, keep: np.ndarray) -> Sets:
        """The sets for which ``keep`` holds."""
        if keep.all():
            return self
        sizes = self.sizes
        return Sets(self.grams[np.repeat(keep, sizes)], np.append(0, np.cumsum(sizes[keep])))


def shingle_sets(texts: list[bytes | None], words: int) -> Sets:
    """Hashes of the word n-grams of each text; of the whole sequence if it has fewer words.

    Words are runs of anything but ASCII white space, with A-Z lower-cased. The texts are hashed
    together, since a call on the few hundred words of one text costs more than its work.
    """
    found = [(t or b"").lower().split() for t in texts]
    count = np.fromiter(map(len, found), np.int64, len(found))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(found)), np.uint64, int(count.sum()))
    width = np.minimum(count, words)
    n = np.where(count > 0, count - width + 1, 0)
    offsets = np.append(0, np.cumsum(n))
    first = np.arange(offsets[-1]) + np.repeat(np.cumsum(count) - count - offsets[:-1], n)
    value = np.repeat(width, n).astype(np.uint64)  # shorter sequences never equal an n-gram
    whole = bool((width[count > 0] == words).all())
    for i in range(words):
        at = slice(None) if whole else np.flatnonzero(np.repeat(width > i, n))
        value[at] = mix64(value[at] ^ hashes[first[at] + i]) + np.uint64(i + 1)
    for start, end in pairwise(offsets.tolist()):
        value[start:end].sort()
    new = np.append(True, value[1:] != value[:-1])[:len(value)]
    new[offsets[:-1][n > 0]] = True
    return Sets(value[new], np.append(0, np.cumsum(new))[offsets])


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams of one text."""
    return shingle_sets([(text or "").encode()], words).grams


def _shingled(texts: pa.Array, words: int) -> Iterator[tuple[int, Sets]]:
    """Runs of texts of about ``GROUP_BYTES``, or one longer text: the place of the first, and their sets."""
    data = texts.cast(pa.binary())
    size = pc.binary_length(data).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.flatnonzero(np.diff((np.cumsum(size) - size) // GROUP_BYTES, prepend=-1))
    for start, end in pairwise([*starts.tolist(), len(data)]):
        yield start, shingle_sets(data.slice(start, end - start).to_pylist(), words)


def largest_difference(a: int, b: int, percent: int) -> int:
    """N-grams that two linked sets of these sizes have apart, at most."""
    return (a + b) * (100 - percent) // (100 + percent)


@lru_cache(maxsize=8)
def _classes(percent: int) -> list[tuple[int, int, int]]:
    """``first size, last size that joins, largest difference`` of each size class."""
    made, first = [], 1
    while first < 1 << 40:
        last = max(first, int(first * CLASS_RATIO) - 1)
        reach = last * 100 // percent
        made.append((first, reach, largest_difference(last, reach, percent)))
        first = last + 1
    return made


@lru_cache(maxsize=1 << 14)
def _classes_of(n: int, percent: int) -> list[tuple[int, int, int]]:
    """``class, fragments, largest difference of its own`` of the size classes of a set of n.

    Equal sets are found by their fingerprint, so a class in which only equal sets link is left out.
    """
    made = []
    for k, (first, reach, difference) in enumerate(_classes(percent)):
        if first > n:
            break
        if reach >= n and difference:
            made.append((k, difference + 1 + math.ceil(SLACK * difference),
                         largest_difference(n, min(reach, n * 100 // percent), percent)))
    return made


class _Cut(NamedTuple):
    """The segments of those sets that have a class left: one class for each of them.

    ``has`` tells which sets, ``kind``, ``cuts`` and ``spare`` are theirs. ``starts`` counts the n-grams of
    these sets alone; ``present`` is the fragment and ``owner`` the set, counted among these, of each segment.
    """

    has: np.ndarray
    kind: np.ndarray
    cuts: np.ndarray
    spare: np.ndarray
    starts: np.ndarray
    present: np.ndarray
    owner: np.ndarray


def _cut(sets: Sets, percent: int) -> Iterator[_Cut]:
    """The segments of each set in its size classes, the first class of all sets first.

    A set with p segments that links agrees with its partner in p minus their largest difference
    at least; ``spare`` is one less. It is negative where they may agree in empty segments only.
    """
    kinds = [_classes_of(n, percent) for n in sets.sizes.tolist()]
    for place in range(max(map(len, kinds), default=0)):
        has = np.fromiter((len(k) > place for k in kinds), bool, len(kinds))
        kind, cuts, own = np.array([k[place] for k in kinds if len(k) > place], np.int64).T
        those = sets.where(has)
        fragment = ((those.grams >> np.uint64(32)) * np.repeat(cuts.astype(np.uint64), those.sizes)) >> np.uint64(32)
        new = np.append(True, fragment[1:] != fragment[:-1])
        new[those.offsets[:-1]] = True
        starts = np.flatnonzero(new)
        counts = np.add.reduceat(new, those.offsets[:-1], dtype=np.int64)
        yield _Cut(has, kind, cuts, counts - own - 1, starts, fragment[starts], np.repeat(np.arange(len(kind)), counts))


def signature_rows(sets: Sets, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and the place of the set of each: one per segment of each size class that the set
    belongs to; the class is in the low bits.

    Sets that link have a signature in common, even if each leaves out as many of its most
    frequent ones, by one order for all sets, as ``spares`` says: the rarest they share has enough
    others before it in both.
    """
    sigs, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    marks = mix64(sets.grams)
    low = np.uint64((1 << CLASS_BITS) - 1)
    for c in _cut(sets, percent):
        at = np.flatnonzero(c.has)
        kind = c.kind.astype(np.uint64)
        place = mix64((kind[c.owner] << np.uint64(40)) + c.present)
        those = marks if c.has.all() else marks[np.repeat(c.has, sets.sizes)]
        made = mix64(np.add.reduceat(those, c.starts) ^ place)
        sigs.append((made & ~low) | kind[c.owner])
        places.append(at[c.owner])
        for i in np.flatnonzero(c.spare < 0):
            own = c.present[slice(*np.searchsorted(c.owner, [i, i + 1]))]
            empty = np.setdiff1d(np.arange(c.cuts[i], dtype=np.uint64), own)
            made = mix64(mix64((kind[i] << np.uint64(40)) + empty) + np.uint64(1))
            sigs.append((made & ~low) | kind[i])
            places.append(np.full(len(empty), at[i]))
    return np.concatenate(sigs).view(np.int64), np.concatenate(places)


def spare_rows(sets: Sets, percent: int) -> list[list[tuple[int, int]]]:
    """``class, signatures that the set may leave out`` in each size class of each set."""
    made: list[list[tuple[int, int]]] = [[] for _ in range(len(sets.offsets) - 1)]
    for c in _cut(sets, percent):
        for i, k, spare in zip(np.flatnonzero(c.has).tolist(), c.kind.tolist(), np.maximum(c.spare, 0).tolist()):
            made[i].append((k, spare))
    return made


def _one(hashes: np.ndarray) -> Sets:
    return Sets(hashes, np.array([0, len(hashes)]))


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of one set."""
    return signature_rows(_one(hashes), percent)[0]


def spares(hashes: np.ndarray, percent: int) -> dict[int, int]:
    """Signatures that one set may leave out, by size class."""
    return dict(spare_rows(_one(hashes), percent)[0])


def fingerprints(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that stand for each set; both are 0 for the empty set."""
    return (sets.sums(mix64(sets.grams)).view(np.int64),
            sets.sums(mix64(sets.grams ^ np.uint64(0x5851F42D4C957F2D))).view(np.int64))


def sketches(sets: Sets) -> pa.Array:
    """Bytes with the number of n-grams in equal ranges of the order, the more ranges the larger the set.

    The sums of two neighbouring ranges are those of a sketch of half as many. A set with more than 255
    n-grams in a range has an empty sketch, which says nothing.
    """
    bits = [max(SKETCH_BITS, ((n - 1) // SKETCH_GRAMS).bit_length()) for n in sets.sizes.tolist()]
    starts = np.append(0, np.cumsum([1 << b for b in bits], dtype=np.int64))
    shift = np.repeat(np.array([64 - b for b in bits], np.uint64), sets.sizes)
    at = np.repeat(starts[:-1], sets.sizes) + (sets.grams >> shift).astype(np.int64)
    counts = np.bincount(at, minlength=starts[-1])
    parts = [counts[a:b] for a, b in pairwise(starts.tolist())]
    return pa.array([c.astype(np.uint8).tobytes() if c.max() < 256 else b"" for c in parts], pa.binary())


def _unpacked(sketch: bytes) -> np.ndarray:
    return np.frombuffer(sketch, np.uint8).astype(np.int32)


def _folded(sketch: np.ndarray, ranges: int) -> np.ndarray:
    return sketch if len(sketch) == ranges else sketch.reshape(ranges, -1).sum(axis=1, dtype=np.int32)


def may_link(sizes: np.ndarray, found: list[bytes], percent: int) -> np.ndarray:
    """Whether sets of these sizes and sketches may link, each with each: false only where they can't.

    What the counts of two sets differ by in a range is apart, at least.
    """
    able = 100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes)
    opened = [_unpacked(s) for s in found]
    for i, a in enumerate(opened):
        near = [j for j in np.flatnonzero(able[i, i + 1:]) + i + 1 if len(a) and len(opened[j])]
        if near:
            ranges = min(len(a), *(len(opened[j]) for j in near))
            others = np.stack([_folded(opened[j], ranges) for j in near])
            apart = np.abs(others - _folded(a, ranges)).sum(axis=1, dtype=np.int64)
            able[i, near] = (100 + percent) * apart <= (100 - percent) * (sizes[near] + sizes[i])
    return np.triu(able, 1) | np.triu(able, 1).T


def _profile(text: Column, words: int, percent: int) -> Column:
    fields = {"n": pa.int64(), "fp1": pa.int64(), "fp2": pa.int64(), "sketch": pa.binary(),
              "spare": pa.map_(pa.int32(), pa.int32())}

    @F.arrow_udf("struct<n long, fp1 long, fp2 long, sketch binary, spare map<int, int>>")
    def profile(texts: pa.Array) -> pa.Array:
        drop_tables()
        parts = [pa.array([], pa.struct(list(fields.items())))]
        for _, sets in _shingled(texts, words):
            sizes = sets.sizes
            parts.append(pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), *(pa.array(f, pa.int64(), mask=sizes == 0) for f in fingerprints(sets)),
                 sketches(sets), pa.array(spare_rows(sets, percent), fields["spare"])], list(fields)))
        return pa.concat_arrays(parts)
    return profile(text)


def _signed(docs: DataFrame, words: int, percent: int, once: bool) -> DataFrame:
    """``sig, id`` of the signatures of each text.

    With ``once`` a set that a task meets again is left out: its ids hang together by their
    fingerprint, so a large group of copies sends one row per signature and task.
    """
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables()
        seen: set[tuple] = set()
        for batch in batches:
            ids = batch["id"].to_numpy()
            for start, sets in _shingled(batch["text"], words):
                keep = sets.sizes > 0
                if once:
                    for at, mark in enumerate(zip(*(f.tolist() for f in fingerprints(sets)))):
                        keep[at] &= mark not in seen
                        seen.add(mark)
                sigs, places = signature_rows(sets.where(keep), percent)
                own = ids[start + np.flatnonzero(keep)[places]]
                for a in range(0, len(sigs), BATCH_SIGNATURES):
                    b = a + BATCH_SIGNATURES
                    yield pa.RecordBatch.from_arrays([pa.array(sigs[a:b]), pa.array(own[a:b])], ["sig", "id"])

    return docs.mapInArrow(sign, "sig long, id long")


def _own_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place and set of the rows whose ``text`` has their ``fp1``: another text is not the id's own."""
    fp1 = batch["fp1"].to_numpy()
    for start, sets in _shingled(batch["text"], words):
        own = fingerprints(sets)[0] == fp1[start:start + len(sets.sizes)]
        for i in np.flatnonzero(own & (sets.sizes > 0)).tolist():
            yield start + i, sets.grams[sets.offsets[i]:sets.offsets[i + 1]]


def _segments(texts: DataFrame, words: int) -> DataFrame:
    """``hub, id, fragment, grams``: the segments of each document, sent to the hubs it is tested with.

    ``texts`` has ``id, text, fp1, hubs``.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables()
        for batch in batches:
            for at, hashes in _own_sets(batch, words):
                i, hubs = batch["id"][at].as_py(), batch["hubs"][at].as_py()
                ends = np.searchsorted(hashes >> np.uint64(61), np.arange(FRAGMENTS + 1))
                ends[-1] = len(hashes)
                full = np.flatnonzero(ends[1:] > ends[:-1])
                grams = pa.ListArray.from_arrays(pa.array(np.append(ends[:-1][full], len(hashes)), pa.int32()),
                                                 pa.array(hashes.view(np.int64)))
                m = len(full)
                for hub in hubs:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(m, hub)), pa.array(np.full(m, i)), pa.array(full, pa.int32()), grams],
                        ["hub", "id", "fragment", "grams"])

    return texts.mapInArrow(cut, "hub long, id long, fragment int, grams array<long>")


def _near(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """``id, hub, n_id, n_hub`` of the pairs ``id, hub`` that may link by their sizes and sketches.

    ``sizes`` is ``id, n, sketch``.
    """
    @F.arrow_udf("boolean")
    def near(n_id: pa.Array, sketch_id: pa.Array, n_hub: pa.Array, sketch_hub: pa.Array) -> pa.Array:
        drop_tables()
        both = zip(np.stack([n_id.to_numpy(), n_hub.to_numpy()], axis=1), sketch_id.to_pylist(), sketch_hub.to_pylist())
        return pa.array([bool(may_link(n, [x, y], percent)[0, 1]) for n, x, y in both], pa.bool_())

    return (pairs.join(sizes.select("id", F.col("n").alias("n_id"), F.col("sketch").alias("sketch_id")), "id")
            .join(sizes.select(F.col("id").alias("hub"), F.col("n").alias("n_hub"),
                               F.col("sketch").alias("sketch_hub")), "hub")
            .where(100 * F.least("n_id", "n_hub") >= percent * F.greatest("n_id", "n_hub"))
            .where(near("n_id", "sketch_id", "n_hub", "sketch_hub")).select("id", "hub", "n_id", "n_hub"))


def _near_in_groups(groups: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """``id, hub, n_id, n_hub`` of the pairs of different label in a group that may link.

    ``groups`` is ``sig, rep, label``, a few members a group, and ``sizes`` ``id, n, sketch``. Groups
    of the same members are one. A group's members come together with their sketches and only pairs
    that may link become rows: rows grow with the members, not with their square.
    """
    def near(table: pa.Table) -> pa.Table:
        drop_tables()
        table = table.sort_by([("crowd", "ascending"), ("rep", "ascending")])
        crowd, rep, label, n = (table[c].to_numpy() for c in ("crowd", "rep", "label", "n"))
        found, ends = table["sketch"].to_pylist(), np.flatnonzero(np.diff(crowd)) + 1
        ids, hubs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for a, b in pairwise([0, *ends.tolist(), len(crowd)]):
            able = may_link(n[a:b], found[a:b], percent) & (label[a:b, None] != label[None, a:b])
            hub, other = np.nonzero(np.triu(able, 1))
            ids.append(a + other)
            hubs.append(a + hub)
        i, j = np.concatenate(ids), np.concatenate(hubs)
        return pa.table({"id": rep[i], "hub": rep[j], "n_id": n[i], "n_hub": n[j]})

    reps = F.sort_array(F.collect_list("rep"))
    crowds = groups.groupBy("sig").agg(reps.alias("reps")).select("reps").distinct()
    # two lists of one hash are one group: more pairs are looked at, none is lost
    crowds = materialize(crowds.select(F.xxhash64("reps").alias("crowd"), F.explode("reps").alias("rep")).distinct(),
                         "crowds")
    buckets = max(1, crowds.count() // BUCKET_MEMBERS)
    return (crowds.join(groups.select("rep", "label").distinct(), "rep")
            .join(sizes.select(F.col("id").alias("rep"), "n", "sketch"), "rep")
            .groupBy(F.pmod("crowd", F.lit(buckets)).alias("bucket"))
            .applyInArrow(near, "id long, hub long, n_id long, n_hub long").distinct())


def _verified(docs: DataFrame, near: DataFrame, sizes: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, hub`` of the pairs that link: partial overlaps per fragment, summed per pair.

    ``docs`` is ``id, text``, ``near`` ``id, hub, n_id, n_hub``, ``sizes`` ``id, fp1``. No n-gram is
    sent for pairs whose sizes or sketches differ by more than linked sets can.
    """
    n = F.col
    sized = materialize(near, "pairs")
    needed = (sized.select("id", "hub").union(sized.select(F.col("hub"), "hub")).distinct()
              .groupBy("id").agg(F.collect_set("hub").alias("hubs"))
              .join(sizes.select("id", "fp1"), "id"))
    segments = materialize(_segments(_texts_of(docs, needed), words), "segments")
    own = segments.where("id = hub").select("hub", "fragment", F.col("grams").alias("hub_grams"))
    shared = (segments.where("id <> hub").join(own, ["hub", "fragment"])
              .select("id", "hub", F.size(F.array_intersect("grams", "hub_grams")).alias("part"))
              .groupBy("id", "hub").agg(F.sum("part").alias("both")))
    links = materialize(shared.join(sized, ["id", "hub"])
                        .where(100 * n("both") >= percent * (n("n_id") + n("n_hub") - n("both")))
                        .select("id", "hub"), "links")
    forget(segments)
    forget(sized)
    return links


def _between(table: pa.Table, percent: int) -> pa.Table:
    """Label pairs to join, from the sets of two blocks (or one) of a family.

    Overlaps are counted fragment by fragment of the n-gram order and summed per pair. Of the links
    between different labels only as many are returned as connect them.
    """
    size = np.diff(table["grams"].combine_chunks().offsets.to_numpy())
    grams = table["grams"].combine_chunks().flatten().to_numpy()
    owner = np.repeat(np.arange(len(size)), size)
    label, block = table["label"].to_numpy(), table["block"].to_numpy()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    order, column = np.unique(grams, return_inverse=True)
    often = np.bincount(column, minlength=len(order)) > 1  # the others are in no overlap
    rank = np.cumsum(often) - 1
    keep = often[column]
    column, owner = rank[column[keep]], owner[keep]
    by_column = np.argsort(column, kind="stable")
    column, owner = column[by_column], owner[by_column]
    both = np.zeros((len(left), len(right)), np.float32)  # whole numbers below 2 ** 24
    width = int(often.sum())
    step = max(1, STEP_CELLS // len(size))
    for start in range(0, width, step):
        a, b = np.searchsorted(column, [start, start + step])
        has = np.zeros((len(size), min(step, width - start)), np.float32)
        has[owner[a:b], column[a:b] - start] = 1
        both += has[left] @ has[right].T
    # both >= percent / 100 of the union, in whole numbers
    linked = (100 + percent) * both.astype(np.int64) >= percent * (size[left][:, None] + size[right][None, :])
    linked &= label[left][:, None] != label[right][None, :]
    i, j = np.nonzero(linked)
    pairs = np.unique(np.sort(np.stack([label[left][i], label[right][j]], axis=1), axis=1), axis=0)
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    kept = []
    for x, y in pairs.tolist():
        a, b = top(x), top(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append((x, y))
    return pa.table({"a": pa.array([k[0] for k in kept], pa.int64()),
                     "b": pa.array([k[1] for k in kept], pa.int64())})


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (with ``id``) and the texts of their ids, repeated rows once."""
    return docs.join(wanted, "id").dropDuplicates(["id", "text"])


def _rest(docs: DataFrame, members: DataFrame, labels: DataFrame, sets: DataFrame, words: int,
          percent: int) -> DataFrame | None:
    """Edges ``a, b`` between labels that groups with several labels still lack.

    Groups that share members form families. Families are cut into blocks by the number of their
    n-grams and each pair of blocks is one task, so none holds a whole family that is large.
    """
    labelled = (members.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
                .withColumn("label", F.coalesce("component", "rep")).drop("component"))
    labelled = materialize(labelled, "labelled")
    split = materialize(labelled.groupBy("sig").agg(F.min("rep").alias("hub"), F.count("*").alias("c"),
                                                    F.min("label").alias("x"), F.max("label").alias("y"))
                        .where("c > 2 and x <> y").select("sig", "hub", "c"), "several")
    split = materialize(labelled.join(split, "sig"), "split")
    if split.isEmpty():
        return None
    near = _near_in_groups(split.where(F.col("c") <= SMALL_GROUP), sets, percent)
    made = _verified(docs, near, sets, words, percent).select(F.col("id").alias("a"), F.col("hub").alias("b"))
    split = split.where(F.col("c") > SMALL_GROUP).select("rep", "hub", "label").distinct()
    if split.isEmpty():
        return made
    families = components(split.select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    placed = (split.select(F.col("rep").alias("id"), "label").distinct()
              .join(families.withColumnRenamed("component", "family"), "id")
              .join(sets.select("id", "n", "fp1"), "id"))
    blocks = placed.groupBy("family").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_GRAMS, F.count("*") / BLOCK_SETS)).cast("int").alias("blocks"))
    placed = (placed.join(blocks, "family")
              .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables()
        for batch in batches:
            keep, grams = [], []
            for i, hashes in _own_sets(batch, words):
                keep.append(i)
                grams.append(hashes.view(np.int64))
            own = batch.select(["family", "blocks", "block", "label"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(grams, pa.list_(pa.int64()))],
                                             [*own.schema.names, "grams"])

    filled = _texts_of(docs, placed).mapInArrow(
        sets_of, "family long, blocks int, block int, label long, grams array<long>")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return made.union(filled.withColumn("other", other)
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .groupBy("family", "i", "j").applyInArrow(lambda t: _between(t, percent), "a long, b long"))


def _relabelled(df: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """The frame with the ids of a column replaced by their component, where ``labels`` has one."""
    known = labels.select(F.col("id").alias("_id"), F.col("component").alias("_label"))
    return (df.join(known, F.col(column) == F.col("_id"), "left")
            .withColumn(column, F.coalesce("_label", column)).drop("_id", "_label"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component`` of every row: the smallest id that links lead to, its own included.

    Two ids link when their sets of ``words``-grams overlap by ``percent`` of their union. Sets
    that are equal are one set from the start. Null and empty texts, and texts of white space, have
    the empty set and link with nothing. Rows with a null id get a null component and link with
    nothing. Where an id comes with several texts, the one with the smallest fingerprint stands for
    the id; n_shingles is still each row's own. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = materialize(docs.select("id", _profile(F.col("text"), words, percent).alias("p"))
                       .select("id", "p.*"), "profile")
    docs = docs.where("id is not null")
    known = rows.where("id is not null and n > 0")
    mark = F.struct("fp1", "fp2", "n")
    own = known.groupBy("id").agg(F.min(mark).alias("s"), F.max(mark).alias("t"),
                                  F.min_by(F.struct("sketch", "spare"), mark).alias("u"))
    # joins split a large group only between two tables as they are, so aggregates are written first
    own = materialize(own.select("id", "s.*", "u.*", (F.col("s") != F.col("t")).alias("several")), "own")
    one_text_each = own.where("several").isEmpty()
    reps = materialize(own.groupBy("fp1", "fp2", "n").agg(F.min("id").alias("rep")), "reps")
    sets = materialize(own.join(reps, ["fp1", "fp2", "n"]).select("id", "n", "fp1", "sketch", "spare", "rep"), "sets")
    forget(own)
    # made twice, once to count and then to pick those that meet: writing them would cost more disk
    # than hashing the texts again costs time
    signed = _signed(docs, words, percent, one_text_each)
    met = materialize(signed.groupBy("sig").agg(F.count("*").alias("c")).where("c > 1"), "met")
    kind = F.col("sig").bitwiseAND((1 << CLASS_BITS) - 1).cast("int")
    shared = (signed.join(met, "sig").join(sets.select("id", "rep", "spare"), "id")
              .select("sig", "rep", "c", kind.alias("kind"), F.element_at("spare", kind).alias("spare"))
              .groupBy("rep", "sig", "kind").agg(F.max("c").alias("c"), F.max("spare").alias("spare")))
    # the most frequent go, as many as a set may leave out; the order is the same for all sets
    order = W.partitionBy("rep", "kind").orderBy(F.desc("c"), "sig")
    members = materialize(shared.withColumn("place", F.row_number().over(order))
                          .where("place > coalesce(spare, 0)").select("sig", "rep"), "members")
    forget(met)
    hubs = materialize(members.groupBy("sig").agg(F.min("rep").alias("hub")), "hubs")
    pairs = (members.join(hubs, "sig").where("rep <> hub")
             .select(F.col("rep").alias("id"), "hub").distinct())
    links = _verified(docs, _near(pairs, sets, percent), sets, words, percent)
    edges = links.select(F.col("id").alias("a"), F.col("hub").alias("b"))
    labels = materialize(components(edges), "labels")
    rest = _rest(docs, members, labels, sets, words, percent)
    forget(members)
    if rest is not None:  # they join labels, so the links that made those needn't be followed again
        rest = materialize(rest, "rest")
        ends = rest.select("a", "b")
        for end in ("a", "b"):
            ends = _relabelled(ends, end, labels)
        # every label is the smallest id of its links, so the smallest label is the smallest id
        above = materialize(components(ends), "above")
        labels = materialize(_relabelled(labels, "component", above).union(
            above.join(labels, "id", "left_anti")), "labels")
    # equal sets hang on their smallest id
    found = _relabelled(sets.select("id", F.col("rep").alias("component")), "component", labels)
    return (rows.select("id", F.col("n").alias("n_shingles")).join(found, "id", "left")
            .withColumn("component", F.coalesce("component", "id")))
