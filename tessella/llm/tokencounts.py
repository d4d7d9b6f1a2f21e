"""Token counts under a unigram model, with scores shared by words of a common prefix.

A text is cut before each run of white space. The distinct pre-tokens of a batch form a trie of
bytes: sorted, each word owns the nodes beyond the prefix it shares with the word before. A node
keeps the forward score of its prefix, the least cost to write it with pieces of the vocabulary and
the number of pieces that takes, computed once and level by level with numpy. The last node of a
word holds its token count, which the Python worker remembers in a table of bounded size. Nothing
is shuffled.
"""

from __future__ import annotations

import base64
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessella.llm.common import mix64, struct_array, text_groups, worker_table

PRETOKENS = re.compile(r"\s*\S+|\s+")
KNOWN_WORDS = 600_000
#: longer pre-tokens hardly ever repeat: they are scored alone and not kept
LONG_WORD = 64
#: costs are whole numbers, so equal costs are equal; the low bits count pieces and break ties
SCALE, PIECE = 1 << 10, 1 << 24
BASE = np.uint64(0x9E3779B97F4A7C15)


def piece_costs(path: str) -> dict[bytes, int]:
    """Cost of each piece of a rank file: Zipf's law over its ranks, ties to fewer pieces."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(piece): round(SCALE * math.log(int(rank) + 2)) * PIECE + 1
            for piece, rank in pairs}


class UnigramTrie:
    """Token counts of words under one vocabulary."""

    def __init__(self, costs: dict[bytes, int], limit: int = KNOWN_WORDS):
        #: every tail of a piece; its cost where it is a piece itself, else 0
        self.tails: dict[bytes, int] = {}
        for piece, cost in costs.items():
            for i in range(1, len(piece)):
                self.tails.setdefault(piece[i:], 0)
            self.tails[piece] = cost
        if not all(self.tails.get(bytes([b])) for b in range(256)):
            raise ValueError("the vocabulary has to hold every byte")
        short = [t for t in self.tails if len(t) <= LONG_WORD]
        keys = np.array([self._key(t) for t in short], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.key_costs = np.array([self.tails[t] for t in short], np.int64)[order]
        if (self.keys[1:] == self.keys[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.limit, self.known = limit, {}

    @staticmethod
    def _key(tail: bytes) -> int:
        """Hash of a tail, the last byte first, as ``_trie_scores`` builds it."""
        value = 0
        for byte in reversed(tail):
            value = (value * int(BASE) + byte + 1) % (1 << 64)
        return int(mix64(np.array([value], np.uint64))[0])

    def _trie_scores(self, words: list[bytes]) -> np.ndarray:
        """Scores of sorted distinct words, none longer than ``LONG_WORD``."""
        size = np.array([len(w) for w in words])
        width = int(size.max())
        chars = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
        chars = np.ascontiguousarray(chars.reshape(len(words), width).T)
        # a word owns the nodes below the longest prefix that it shares with the word before
        differs = np.ones((width + 1, len(words)), bool)
        differs[:width, 1:] = chars[:, 1:] != chars[:, :-1]
        shared = np.minimum(differs.argmax(axis=0), np.minimum(size, np.append(0, size[:-1])))
        shared[0] = 0
        codes = chars.astype(np.uint64) + np.uint64(1)
        score = np.zeros((width + 1, len(words)), np.int64)
        at = np.arange(len(words))
        for depth in range(1, width + 1):
            own = np.flatnonzero((shared < depth) & (size >= depth))
            rows, value = own, np.zeros(len(own), np.uint64)
            best = np.full(len(words), np.iinfo(np.int64).max)
            for back in range(1, depth + 1):
                value = value * BASE + codes[depth - back, rows]
                key = mix64(value)
                found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[found] == key
                rows, value, cost = rows[hit], value[hit], self.key_costs[found[hit]]
                if not len(rows):
                    break  # no piece ends with these bytes, nor with more of them
                piece = cost > 0
                ended = rows[piece]
                best[ended] = np.minimum(best[ended], score[depth - back, ended] + cost[piece])
            # a word without a node of its own at this depth reads that of the owner before it
            owner = np.maximum.accumulate(np.where(np.isin(at, own, assume_unique=True), at, 0))
            score[depth] = best[owner]
        return score[size, at]

    def _alone(self, word: bytes) -> int:
        tails, score = self.tails, [0]
        for end in range(1, len(word) + 1):
            best = None
            for start in range(end - 1, -1, -1):
                own = tails.get(word[start:end])
                if own is None:
                    break
                if own and (best is None or score[start] + own < best):
                    best = score[start] + own
            score.append(best)
        return score[-1]

    def tokens(self, words: list[str]) -> list[int]:
        """Tokens of distinct pre-tokens."""
        coded = [w.encode() for w in words]
        short = sorted({w for w in coded if len(w) <= LONG_WORD})
        made = dict(zip(short, self._trie_scores(short).tolist())) if short else {}
        return [(made[w] if len(w) <= LONG_WORD else self._alone(w)) % PIECE for w in coded]

    def counts(self, texts: list[str]) -> list[tuple[int, int]]:
        """Pre-tokens and tokens of each text."""
        cut = [PRETOKENS.findall(t) for t in texts]
        words = set().union(*cut)
        fresh = list(words.difference(self.known))
        if len(self.known) + len(fresh) > self.limit:
            self.known.clear()
            fresh = list(words)
        self.known.update(zip(fresh, self.tokens(fresh)))
        made = [(len(words), sum(map(self.known.__getitem__, words))) for words in cut]
        for word in fresh:
            if len(word) > LONG_WORD:
                del self.known[word]
        return made


def _made(path: str) -> UnigramTrie:
    return UnigramTrie(piece_costs(path))


def _trie(path: str) -> UnigramTrie:
    return worker_table(_made, path)


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, n_bytes, n_pretokens, n_tokens`` of every row under a public rank file.

    The tokens are those of the segmentation of least cost; of several, the one with fewest pieces.
    Null and empty texts have none. One row per input row, repeated rows included; other columns
    are not read.
    """
    @F.arrow_udf("struct<n_bytes long, n_pretokens long, n_tokens long>")
    def count(texts: pa.Array) -> pa.Array:
        trie = _trie(vocabulary)
        size, words, tokens = [], [], []
        for _, group in text_groups(texts.to_pylist()):
            for text, (w, t) in zip(group, trie.counts(group)):
                size.append(len(text.encode()))
                words.append(w)
                tokens.append(t)
        return struct_array({"n_bytes": (size, pa.int64()), "n_pretokens": (words, pa.int64()),
                             "n_tokens": (tokens, pa.int64())})
    return (docs.select(F.col(id_col), count(F.col(text_col)).alias("_c"))
            .select(id_col, "_c.n_bytes", "_c.n_pretokens", "_c.n_tokens"))
