"""SentencePiece encoding through a table of distinct marked words.

A piece of the vocabulary holds the white space marker only at its start, so no merge crosses the
place where a marker follows another character. A text is therefore cut there, each distinct chunk
is segmented once, and the ids of a text are the chunks' ids joined by position. The table lives in
the Python worker, is filled a batch at a time and emptied when it is full, so memory is bounded and
no word is ever shuffled. Ids are kept as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from tessella.llm.common import struct_array, text_groups, worker_table

MARKER = "▁"
CHUNKS = re.compile(f"[ {MARKER}]*[^ {MARKER}]+|[ {MARKER}]+")
TABLE_CHUNKS = 200_000
LONG_CHUNK = 64


class PieceTable:
    """Ids of distinct chunks under one model."""

    def __init__(self, model: str, limit: int = TABLE_CHUNKS):
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model)
        names = [self.processor.id_to_piece(i) for i in range(self.processor.vocab_size())]
        crossing = [p for p in names if re.search(f"[^{MARKER}]{MARKER}", p)]
        plain = self.processor.encode(f"{MARKER} a", out_type=str)
        if crossing or "".join(plain) != MARKER * 3 + "a":
            raise ValueError("the model has pieces across white space or rewrites its input")
        self.begin = self._bytes([self.processor.bos_id()])
        self.end = self._bytes([self.processor.eos_id()])
        self.marker = self._bytes([self.processor.piece_to_id(MARKER)])
        self.is_byte = np.array([self.processor.is_byte(i) or self.processor.is_unknown(i)
                                 for i in range(len(names))])
        self.limit, self.known = limit, {}

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def _segment(self, chunks: list[str]) -> list[bytes]:
        """The model adds the first marker by itself; a lone marker is its own piece."""
        made = self.processor.encode([c[1:] for c in chunks], num_threads=1)
        return [self._bytes(ids) if len(c) > 1 else self.marker for c, ids in zip(chunks, made)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text without begin and end."""
        cut = [CHUNKS.findall(" " + t) if t else [] for t in texts]
        fresh = list(set().union(*cut).difference(self.known)) if cut else []
        if len(self.known) + len(fresh) > self.limit:
            self.known.clear()
            fresh = list(set().union(*cut))
        table = self.known
        short = [c for c in fresh if len(c) <= LONG_CHUNK]
        table.update(zip(short, self._segment(short)))
        if len(short) < len(fresh):  # long chunks hardly ever repeat, so they don't stay
            long = [c for c in fresh if len(c) > LONG_CHUNK]
            table = {**{c: table[c] for c in set().union(*cut) if len(c) <= LONG_CHUNK},
                     **dict(zip(long, self._segment(long)))}
        return [b"".join(map(table.__getitem__, chunks)) for chunks in cut]

    def decode(self, ids: bytes) -> str:
        return self.processor.decode(np.frombuffer(ids, "<u4").tolist())


def piece_table(model: str) -> PieceTable:
    """The table of a model in this Python worker."""
    return worker_table(PieceTable, model)


def piece_ids(text: Column, model: str, begin: bool = True, end: bool = True) -> Column:
    """Column of id arrays of whole texts (null counts as empty)."""
    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        made = piece_table(model)
        out = []
        for _, group in text_groups(texts.to_pylist()):
            out += [np.frombuffer(made.begin * begin + ids + made.end * end, "<i4")
                    for ids in made.ids(group)]
        return pa.array(out, pa.list_(pa.int32()))
    return encode(text)


def piece_texts(ids: Column, model: str) -> Column:
    """Column of the texts that id arrays stand for (null counts as no ids)."""
    @F.arrow_udf("string")
    def decode(arrays: pa.Array) -> pa.Array:
        processor = piece_table(model).processor
        return pa.array([processor.decode(a or []) for a in arrays.to_pylist()], pa.string())
    return decode(ids)


def round_trip_digests(docs: DataFrame, model: str, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` of every row, ids with begin and end.

    Null and empty texts have the begin and end ids only and decode to the empty text. One row per
    input row, repeated rows included; other columns are not read. Nothing is shuffled.
    """
    @F.arrow_udf("struct<n_tokens long, ids_sha256 string, decoded_sha256 string>")
    def digest(texts: pa.Array) -> pa.Array:
        made = piece_table(model)
        n, ids_sha, text_sha = [], [], []
        for _, group in text_groups(texts.to_pylist()):
            for ids in made.ids(group):
                ids = made.begin + ids + made.end
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(made.decode(ids).encode()).hexdigest())
        return struct_array({"n_tokens": (n, pa.int64()), "ids_sha256": (ids_sha, pa.string()),
                             "decoded_sha256": (text_sha, pa.string())})
    return (docs.select(F.col(id_col), digest(F.col(text_col)).alias("_d"))
            .select(id_col, "_d.n_tokens", "_d.ids_sha256", "_d.decoded_sha256"))
