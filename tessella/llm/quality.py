"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Document statistics are standardised and sent through random Fourier features, which approximate a
Gaussian kernel. Tasks sum the normal equations of their labelled rows, the sums are added in two
levels, and one small system is solved on the driver. Scores of held-back labelled rows, binned,
give a monotone map to probabilities by pooling adjacent violators.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessella.llm.common import WORD_SPACE, in_sample, sample_share, struct_array

_B = np.arange(256)


def _of(chars: str) -> np.ndarray:
    return np.isin(_B, np.frombuffer(chars.encode(), np.uint8))


CLASSES = {
    "space": _of(WORD_SPACE), "upper": (_B >= 65) & (_B <= 90), "lower": (_B >= 97) & (_B <= 122),
    "digit": (_B >= 48) & (_B <= 57), "point": _of(".,;:'\"()-"), "shout": _of("!?"),
    "symbol": _of("#*$%&|<>@~^=+_/\\{}[]`"), "lead": _B >= 0xC0,
}
STATISTICS = ("log_words", "word_chars", "word_spread", *(f"{c}_share" for c in CLASSES if c != "space"),
              "bar_share", "dup_lines", "distinct_words", "top_word", "short_words", "long_words",
              "capital_words", "clean_words", "line_words", "sentences", "char_entropy", "repeat_pairs")


def statistics(text: str) -> list[float]:
    """Statistics of a whole text, all finite; an empty text has zeros."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = kinds / len(data)
    dense = max(1, len(data) - int(kinds[CLASSES["space"]].sum()))
    size = np.fromiter(map(len, words), np.float64, n)
    lines = [line for line in data.split(b"\n") if line.strip()]
    distinct = len(set(words))
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    hit = share[share > 0]
    return [
        np.log1p(n), size.mean(), size.std(),
        *(float(kinds[mask].sum()) / dense for name, mask in CLASSES.items() if name != "space"),
        kinds[ord("|")] / dense, 1.0 - len(set(lines)) / len(lines), distinct / n,
        max(counts.values()) / n, float((size <= 3).mean()), float((size > 14).mean()),
        sum(w[:1].isupper() for w in words) / n, sum(map(bytes.isalpha, words)) / n,
        np.log1p(n / len(lines)), (kinds[ord(".")] + kinds[ord("!")] + kinds[ord("?")]) / n,
        float(-(hit * np.log2(hit)).sum()),
        1.0 - len(set(zip(words, words[1:]))) / max(1, n - 1),
    ]


def statistics_of(text: Column) -> Column:
    """Column of statistics arrays of whole texts; a null text counts as empty."""
    @F.arrow_udf("array<double>")
    def stats(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t or "") for t in texts.to_pylist()], pa.list_(pa.float64()))
    return stats(text)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    frequency: np.ndarray  # statistics x features
    phase: np.ndarray
    weight: np.ndarray
    knots: np.ndarray      # ridge scores, increasing
    levels: np.ndarray     # calibrated probabilities at the knots

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6.0, 6.0)
        waves = np.cos(z @ self.frequency + self.phase) * np.sqrt(2.0 / len(self.phase))
        return np.hstack([np.ones((len(x), 1)), z, waves])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        # row by row, so that a score doesn't depend on the rows of its batch
        return np.einsum("ij,j->i", self.features(x), self.weight)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weight):
            return np.full(len(x), 0.5)
        if not len(self.knots):
            return np.clip(self.ridge(x), 0.0, 1.0)
        return np.clip(np.interp(self.ridge(x), self.knots, self.levels), 0.0, 1.0)


def isotonic(scores: np.ndarray, positives: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order of score: block centres and their levels."""
    blocks: list[list[float]] = []
    for s, p, n in zip(scores, positives, rows):
        blocks.append([s * n, p, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    made = np.array(blocks).reshape(-1, 3)
    return made[:, 0] / made[:, 2], made[:, 1] / made[:, 2]


def _normal_equations(rows: DataFrame, model: QualityModel) -> np.ndarray:
    """Sum of [f y][f y]' over the rows, added up in two levels of bounded arrays."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = np.array(batch["x"].to_pylist(), float)
            if len(x):
                f = np.hstack([model.features(x), batch["y"].to_numpy(False)[:, None].astype(float)])
                total = f.T @ f if total is None else total + f.T @ f
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py()) for p in table["part"])
        return pa.table({"part": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("x", "y").mapInArrow(local, "part binary")
    for fan in (64, 1):  # each group adds the parts of its tasks
        parts = (parts.groupBy(F.pmod(F.xxhash64("part"), F.lit(fan)).alias("g"))
                 .applyInArrow(added, "part binary"))
    found = parts.first()
    width = len(model.mean) + len(model.phase) + 2
    return np.frombuffer(found["part"]).reshape(width, width) if found else np.zeros((width, width))


def fit_quality_model(rows: DataFrame, n_features: int = 192, width: float = 0.35, ridge: float = 1e-3,
                      n_bins: int = 2048, fit_rows: int = 200_000, seed: int = 7) -> QualityModel:
    """Learn from rows ``key, x array<double>, y 0 or 1, calibrate boolean``.

    Rows with ``calibrate`` only serve the calibration. At most about ``fit_rows`` rows are used,
    picked by a hash of the key: the bound of the sample. Without rows to calibrate by, the scores are
    those of the ridge, cut off at 0 and 1; without rows to fit, all are 0.5. With one label only the
    scores lie near it. ``rows`` are read several times, so they should be written beforehand.
    """
    rows = rows.where("x is not null and y in (0, 1)")
    n, names = rows.count(), len(STATISTICS)
    rows = rows.where(in_sample(F.col("key"), sample_share(n, fit_rows)))
    at = [F.col("x")[i] for i in range(names)]
    moments = rows.where("not calibrate").agg(
        *[F.avg(c) for c in at], *[F.stddev_pop(c) for c in at]).first()
    moments = np.array([v if v is not None else 0.0 for v in moments], float)
    rng = np.random.default_rng(seed)
    model = QualityModel(
        moments[:names], np.where(moments[names:] > 1e-9, moments[names:], 1.0),
        rng.standard_normal((names, n_features)) * width, rng.uniform(0, 2 * np.pi, n_features),
        np.empty(0), np.empty(0), np.empty(0))
    sums = _normal_equations(rows.where("not calibrate"), model)
    if not sums[0, 0]:
        return model
    total = max(1.0, sums[0, 0])
    penalty = np.eye(len(sums) - 1) * ridge * total
    penalty[0, 0] = 1e-9
    model.weight = np.linalg.solve(sums[:-1, :-1] + penalty, sums[:-1, -1])

    @F.arrow_udf("double")
    def ridge_score(x: pa.Array) -> pa.Array:
        return pa.array(model.ridge(np.array(x.to_pylist(), float).reshape(len(x), -1)))

    step = 2.0 / n_bins  # ridge scores mostly lie in (0, 1); beyond (-0.5, 1.5) they share a bin
    bins = (rows.where("calibrate")
            .select(F.floor(F.least(F.greatest(ridge_score("x"), F.lit(-0.5)), F.lit(1.5)) / step).alias("bin"), "y")
            .groupBy("bin").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
            .toArrow().sort_by("bin"))  # at most n_bins + 1 rows
    if bins.num_rows:
        model.knots, model.levels = isotonic((bins["bin"].to_numpy() + 0.5) * step, bins["p"].to_numpy(),
                                             bins["n"].to_numpy())
    return model


def quality_score(x: Column, model: QualityModel, spark) -> Column:
    """Column of scores (0 to 1) of statistics arrays; equal statistics get equal scores."""
    shared = spark.sparkContext.broadcast(model)  # its size depends on the features only

    @F.arrow_udf("double")
    def score(arrays: pa.Array) -> pa.Array:
        x = np.array(arrays.to_pylist(), float).reshape(len(arrays), -1)
        return pa.array(shared.value.score(x) if len(x) else np.empty(0))
    return score(x)
