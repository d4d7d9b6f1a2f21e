"""Packing token sequences: cutting-stock column generation over a histogram of lengths.

Every document becomes tokens and an end id; full sequences are cut off its front, half a sequence
off what remains if that is longer, and the rest is one piece. So no piece but a full one is longer
than half a sequence, and the pieces always fit together well, however lengths are distributed. Lengths of pieces are counted in classes, so the linear program and its rounding see a
histogram of fixed size, whatever the corpus. Pieces of a class are ranked, ranks are dealt to the
patterns, and every piece finds its sequence from its class and rank alone.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tessella.llm.common import materialize, text_groups, worker_table
from tessella.llm.cutting import stock_plan

#: Unicode white space and the pattern that splits a text before byte merges: fixed values
SPACE = "\t-\r \x85\xa0  -     　"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: no pre-token goes on after white space that follows another character
CHUNKS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
TABLE_CHUNKS, LONG_CHUNK = 400_000, 64
#: pieces of a chunk of ranks, as a power of two
CHUNK_BITS = 15


class ByteTable(dict):
    """Ids of distinct chunks as little-endian unsigned 32-bit integers, filled on demand."""

    def __init__(self, ranks: str, special: tuple[tuple[str, int], ...] = ()):
        super().__init__()
        # special tokens are cut out of a text before anything else, the longer of two that begin together
        self.special = {token: array("I", [i]).tobytes() for token, i in special}
        self.splits = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, special_tokens={},
            mergeable_ranks={base64.b64decode(piece): int(rank) for piece, rank in pairs})

    def __missing__(self, chunk: str) -> bytes:
        made = array("I", self.encoding.encode_ordinary(chunk)).tobytes()
        if len(chunk) <= LONG_CHUNK:
            self[chunk] = made
        return made

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self) > TABLE_CHUNKS:
            self.clear()
        return [self._ids(t) for t in texts]

    def _ids(self, text: str) -> bytes:
        if not any(token in text for token in self.special):
            return b"".join(map(self.__getitem__, CHUNKS.findall(text)))
        return b"".join(self.special.get(part) or b"".join(map(self.__getitem__, CHUNKS.findall(part)))
                        for part in self.splits.split(text))


def special_tokens(tokenizer: str) -> tuple[tuple[str, int], ...]:
    """Special tokens that a tokenizer file (JSON) lists, with their ids: the library finds them in texts."""
    with open(tokenizer, encoding="utf-8") as lines:
        return tuple((t["content"], t["id"]) for t in json.load(lines)["added_tokens"] if t["special"])


def byte_table(ranks: str, special: tuple[tuple[str, int], ...] = ()) -> ByteTable:
    """The table of a vocabulary in this Python worker."""
    return worker_table(ByteTable, ranks, special)


def pieces_of(text: Column, ranks: str, end_id: int, length: int,
              special: tuple[tuple[str, int], ...] = ()) -> Column:
    """Column of ``array<struct<start, length, ids_crc32, doc_tokens>>``; a null text counts as empty."""
    @F.arrow_udf("array<struct<start long, length long, ids_crc32 long, doc_tokens long>>")
    def cut(texts: pa.Array) -> pa.Array:
        table, tail = byte_table(ranks, special), array("I", [end_id]).tobytes()
        at, start, size, crc, total = [0], [], [], [], []
        for _, group in text_groups(texts.to_pylist()):
            for ids in table.ids(group):
                ids = memoryview(ids + tail)
                n = len(ids) // 4
                cuts = [*range(0, n, length), n]
                if cuts[-1] - cuts[-2] > length // 2:  # two pieces fit more sequences than a long one
                    cuts.insert(-1, cuts[-2] + length // 2)
                for a, b in zip(cuts, cuts[1:]):
                    part = ids[4 * a:4 * b]
                    start.append(a)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                at.append(len(start))
        rows = pa.StructArray.from_arrays(
            [pa.array(x, pa.int64()) for x in (start, size, crc, total)],
            ["start", "length", "ids_crc32", "doc_tokens"])
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)
    return cut(text)


def _dealt(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per class the rows ``first rank, pieces per sequence, first sequence, first slot``."""
    rows: dict[int, list] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for counts, times in plan:
        slot = 0
        for size in sorted(counts, reverse=True):
            n = counts[size]
            rows.setdefault(size, []).append((ranks.get(size, 0), n, sequence, slot))
            ranks[size] = ranks.get(size, 0) + n * times
            slot += n
        sequence += times
    return {size: np.array(r, np.int64) for size, r in rows.items()}


def pack(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text", length: int = 2048,
         end_id: int = 1, grain: int = 4, special: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """``id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` of every piece.

    Sequences hold ``length`` tokens at most; pieces follow each other without a gap from offset 0,
    longer classes first. Each row of ``docs`` is packed by itself, repeated rows and rows without an
    id included; a null or empty text is the end id alone. Lengths are counted in steps of ``grain``
    tokens, so a piece may leave up to ``grain - 1`` tokens unused. No rows give no pieces. The strings of
    ``special`` in a text become their id, as ``special_tokens`` lists them for a vocabulary; without
    it they are ordinary text.
    """
    if length % grain:
        raise ValueError("grain has to divide length")
    piece = F.explode(pieces_of(F.col(text_col), ranks, end_id, length, special)).alias("p")
    pieces = materialize(docs.select(F.col(id_col).alias("id"), piece).select("id", "p.*")
                         .withColumn("class", F.ceil(F.col("length") / grain).cast("int"))
                         # runs of rows as they are written: their number grows with the rows, whatever the ids
                         .withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), CHUNK_BITS)), "pieces")
    full = length // grain
    histogram = {r["class"]: r["n"] for r in pieces.groupBy("class").agg(F.count("*").alias("n")).collect()}
    short = np.array(sorted(c for c in histogram if c < full), np.int64)  # length / grain classes at most
    plan = [({full: 1}, histogram[full])] if full in histogram else []
    plan += stock_plan(short, np.array([histogram[c] for c in short], np.int64), full)
    dealt = docs.sparkSession.sparkContext.broadcast(_dealt(plan))  # bounded by the classes

    # ranks within a class by chunks, so that a class with a third of all pieces is split
    every = ["id", "start", "ids_crc32", "length", "doc_tokens"]
    before = W.partitionBy("class").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = (pieces.groupBy("class", "chunk").agg(F.count("*").alias("n"))
               .select("class", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    ranked = (pieces.join(offsets, ["class", "chunk"])
              .withColumn("rank", F.col("before") - 1 + F.row_number().over(
                  W.partitionBy("class", "chunk").orderBy(*every))))

    @F.arrow_udf("struct<sequence_id long, slot long>")
    def place(classes: pa.Array, rank: pa.Array) -> pa.Array:
        classes, rank = classes.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, slot = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for c in np.unique(classes):
            mine = np.flatnonzero(classes == c)
            rows = dealt.value[int(c)]
            found = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
            since = rank[mine] - found[:, 0]
            sequence[mine] = found[:, 2] + since // found[:, 1]
            slot[mine] = found[:, 3] + since % found[:, 1]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(slot)], ["sequence_id", "slot"])

    inside = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    return (ranked.withColumn("at", place("class", "rank")).select(*every, "at.sequence_id", "at.slot")
            .withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
            .select("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
