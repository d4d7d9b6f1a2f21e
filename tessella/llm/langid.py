"""Language by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased, everything but letters becomes one space, and the 1- to 3-grams of what is
left are hashed into a fixed number of buckets. Tasks count their grams per language; the summed
counts give a matrix of log-probabilities whose size depends only on the buckets and languages, so
it is broadcast. Scoring adds the rows of the matrix that a text hits, for a batch at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessella.llm.common import code_points, in_sample, sample_share, struct_array, text_groups

UNDETERMINED = "und"
ORDERS = (1, 2, 3)
#: code points of one text that are scored at a time
WINDOW = 1 << 20
#: grams of a batch of sparse rows, and cells of its product with the model at a time
BATCH_GRAMS, PRODUCT_CELLS = 1 << 18, 1 << 20


@dataclass
class LanguageModel:
    languages: list[str]
    log_prob: np.ndarray  # buckets x languages
    log_prior: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _letters_of(text: str) -> np.ndarray:
    """Lower-cased code points; each run of anything but letters is one space."""
    points = code_points(text.lower())
    points = np.where(_letters()[points], points, np.uint32(32))
    if not len(points):
        return points
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
    return points[keep]


def _pad(points: np.ndarray) -> np.ndarray:
    return np.concatenate([[32], points, [32]]).astype(np.uint64)


def _buckets(points: np.ndarray, buckets: int, starts: int) -> np.ndarray:
    """Bucket of every gram that begins among the first ``starts`` points, order by order."""
    out = []
    for n in ORDERS:
        m = min(len(points) - n + 1, starts)
        if m <= 0:
            continue
        value = np.full(m, n, np.uint64)
        for i in range(n):
            value = (value ^ points[i:m + i]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
        out.append((value % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(out) if out else np.empty(0, np.int64)


def _windows(text: str, buckets: int) -> Iterator[np.ndarray]:
    """Grams of a whole text, a window of their starting points at a time."""
    points = _pad(_letters_of(text))
    reach = max(ORDERS) - 1
    for start in range(0, len(points), WINDOW):
        yield _buckets(points[start:start + WINDOW + reach], buckets, WINDOW)


def fit_language_model(docs: DataFrame, text: Column, lang: Column, key: Column,
                       n_buckets: int = 1 << 15, smoothing: float = 0.1, fit_rows: int = 100_000,
                       max_cells: int = 1 << 23) -> LanguageModel:
    """Learn from the rows of ``docs`` that have a text and a language.

    At most about ``fit_rows`` rows are used, picked by a hash of ``key``: the bound of the sample, so the
    model knows as many languages at most. Buckets are halved until buckets x languages, what is broadcast,
    is within ``max_cells`` (from 257 languages on, as it stands). Without any row the model knows no language.
    """
    rows = (docs.select(text.alias("t"), lang.alias("l"), key.alias("k"))
            .where("t is not null and l is not null"))
    rows = rows.where(in_sample(F.col("k"), sample_share(rows.count(), fit_rows)))
    languages = rows.select("l").distinct().count()
    while n_buckets > 2 and n_buckets * languages > max_cells:
        n_buckets //= 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            for t, name in zip(batch["t"].to_pylist(), batch["l"].to_pylist()):
                sums = seen.setdefault(name, np.zeros(n_buckets, np.int64))
                docs_of[name] = docs_of.get(name, 0) + 1
                for grams in _windows(t, n_buckets):
                    sums += np.bincount(grams, minlength=n_buckets)
        for name, sums in seen.items():
            hit = np.flatnonzero(sums)
            at = np.append(hit, -1).astype(np.int32)  # -1: number of texts
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at),
                 pa.array(np.append(sums[hit], docs_of[name]))], ["l", "bucket", "n"])

    counts = (rows.select("t", "l").mapInArrow(count, "l string, bucket int, n long")
              .groupBy("l", "bucket").agg(F.sum("n").alias("n")))
    found = counts.toArrow()  # at most languages x buckets rows
    names = sorted(set(found["l"].to_pylist()))
    matrix, texts = np.zeros((n_buckets, len(names))), np.zeros(len(names))
    column = {name: i for i, name in enumerate(names)}
    langs = np.array([column[x] for x in found["l"].to_pylist()], np.int64)
    bucket, n = found["bucket"].to_numpy(), found["n"].to_numpy()
    gram = bucket >= 0
    matrix[bucket[gram], langs[gram]] = n[gram]
    texts[langs[~gram]] = n[~gram]
    smoothed = matrix + smoothing
    return LanguageModel(names, np.log(smoothed / smoothed.sum(axis=0)) if names else matrix,
                         np.log(texts / texts.sum()) if names else texts)


def _add_rows(out: np.ndarray, keys: list[np.ndarray], log_prob: np.ndarray) -> None:
    """Add the product of a sparse matrix (texts x buckets, entries as keys) and the log-probabilities."""
    if not keys:
        return
    cell, count = np.unique(np.concatenate(keys), return_counts=True)
    row, bucket = np.divmod(cell, len(log_prob))
    step = max(1, PRODUCT_CELLS // log_prob.shape[1])
    for a in range(0, len(row), step):
        own, first = np.unique(row[a:a + step], return_index=True)
        product = count[a:a + step, None] * log_prob[bucket[a:a + step]]
        out[own] += np.add.reduceat(product, first, axis=0)


def _score(model: LanguageModel, texts: list[str]) -> np.ndarray:
    """Log-probability of each text and language, a batch of sparse rows at a time."""
    n_buckets = len(model.log_prob)
    out = np.tile(model.log_prior, (len(texts), 1))
    keys, held = [], 0
    for i, text in enumerate(texts):
        for grams in _windows(text, n_buckets):
            keys.append(grams + i * n_buckets)
            held += len(grams)
            if held >= BATCH_GRAMS:
                _add_rows(out, keys, model.log_prob)
                keys, held = [], 0
    _add_rows(out, keys, model.log_prob)
    return out


def predict_language(text: Column, model: LanguageModel, spark) -> Column:
    """Column of ``struct<lang_pred, score>`` for a column of texts.

    A null text, or one without a letter, gets ``und`` and score 0; so does every text under a model
    without languages. Equal scores go to the language whose name sorts first.
    """
    shared = spark.sparkContext.broadcast(model)  # buckets x languages, both bounded

    @F.arrow_udf("struct<lang_pred string, score double>")
    def predict(texts: pa.Array) -> pa.Array:
        known = shared.value
        names, scores = [], []
        for _, group in text_groups(texts.to_pylist()):
            logs = _score(known, group) if known.languages else np.zeros((len(group), 0))
            for t, row in zip(group, logs):
                if not len(row) or not any(map(str.isalpha, t)):
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                best = int(np.argmax(row))
                names.append(known.languages[best])
                scores.append(float(1.0 / np.exp(row - row[best]).sum()))
        return struct_array({"lang_pred": (names, pa.string()), "score": (scores, pa.float64())})
    return predict(text)
