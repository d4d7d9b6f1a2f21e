"""Quality rules from tokeniser fertility: how a public vocabulary fits a text.

Per document: characters per token, share of byte-fallback tokens and token entropy under a public
SentencePiece vocabulary, besides plain counts of words, symbols and repetitions. The bands that a
document has to lie in are learned for each language (or, where none is given, script) and class of
token count from all documents: robust quantiles of binned measures, so that the counting is one
small aggregate.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tessella.llm.common import WORD_SPACE, forget, materialize, mix64, row_of, struct_array, text_groups
from tessella.llm.pieces import piece_table

#: characters that count as symbols: a fixed value of the contract
SYMBOLS = "#*$%&|<>"
#: words of a window, and the limits of the base rule in words and percent: fixed values
REPEAT_WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

MEASURES = ("chars_per_token", "fallback_share", "entropy_share")
#: bins per unit of each measure
BINS = {"chars_per_token": 64, "fallback_share": 1024, "entropy_share": 1024}
#: rows of bands up to which they are broadcast; more are joined
SMALL_BANDS = 30_000

_SYMBOL_BYTES = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
_SPACE_BYTES = np.isin(np.arange(256), np.frombuffer(WORD_SPACE.encode(), np.uint8))
_LATER_BYTES = (np.arange(256) & 0xC0) == 0x80  # of a code point in UTF-8

BASE_SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
               "n_repeat_words long")


def _repeat_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that the text holds at least twice."""
    n = len(words) - REPEAT_WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    window = np.zeros(n, np.uint64)
    for i in range(REPEAT_WINDOW):
        window = mix64(window ^ hashes[i:n + i]) + np.uint64(i + 1)
    order = np.argsort(window, kind="stable")
    same = window[order][1:] == window[order][:-1]
    if not same.any():
        return 0
    repeated = np.zeros(n, bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    ends = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(repeated)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + REPEAT_WINDOW, -1)
    return int((np.cumsum(ends)[:-1] > 0).sum())


def _dup_lines(data: bytes) -> int:
    seen, count = set(), 0
    for line in data.split(b"\n"):
        if line in seen:
            count += bool(line.split())
        else:
            seen.add(line)
    return count


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, characters in words, symbols, repeated lines and repeated words of a text."""
    data = text.encode()
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    words = data.split()  # bytes are split at ASCII white space only
    points = len(data) - int(kinds[_LATER_BYTES].sum())
    return (len(words), points - int(kinds[_SPACE_BYTES].sum()), int(kinds[_SYMBOL_BYTES].sum()),
            _dup_lines(data), _repeat_words(words))


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


#: first code point of blocks and the script they mostly hold (Unicode block ranges, fixed values)
SCRIPTS = [(0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"),
           (0x0590, "Hebrew"), (0x0600, "Arabic"), (0x0900, "Indic"), (0x0E00, "Thai"),
           (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1E00, "Latin"), (0x1F00, "Greek"),
           (0x2000, "other"), (0x3040, "Kana"), (0x3100, "Han"), (0xAC00, "Hangul"),
           (0xD800, "other"), (0x20000, "Han"), (0x30000, "other")]


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def script_of(text: str) -> str:
    """The script of most letters; ``none`` without letters, ties to the earlier block."""
    if text.isascii():
        return "Latin" if any(map(str.isalpha, text)) else "none"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points[_letters()[points]]
    if not len(points):
        return "none"
    block = np.searchsorted([s for s, _ in SCRIPTS], points, side="right") - 1
    counts: dict[str, int] = {}
    for i, n in enumerate(np.bincount(block, minlength=len(SCRIPTS))):
        counts[SCRIPTS[i][1]] = counts.get(SCRIPTS[i][1], 0) + int(n)
    return max(counts, key=counts.__getitem__)


def _fertility(text: str, ids: np.ndarray, is_byte: np.ndarray) -> tuple[float, float, float]:
    """Characters per token, byte-fallback share, entropy as a share of the largest possible."""
    if len(ids) < 2:
        return float(len(text)), 0.0, 1.0
    # line breaks and tabs are bytes in any text: they say nothing about the vocabulary's fit
    fallback = int(is_byte[ids].sum()) - sum(map(text.count, WORD_SPACE[1:]))
    counts = np.unique(ids, return_counts=True)[1] / len(ids)
    entropy = -(counts * np.log2(counts)).sum() / np.log2(min(len(ids), len(is_byte)))
    return len(text) / len(ids), max(0, fallback) / len(ids), float(entropy)


def measured(text: Column, model: str) -> Column:
    """Column of a struct: the base counts, the three measures and the script of whole texts."""
    @F.arrow_udf(f"struct<{BASE_SCHEMA}, n_tokens long, chars_per_token double, "
                 "fallback_share double, entropy_share double, script string>")
    def measure(texts: pa.Array) -> pa.Array:
        pieces = piece_table(model)
        rows = []
        for _, group in text_groups(texts.to_pylist()):
            for t, ids in zip(group, pieces.ids(group)):
                ids = np.frombuffer(ids, "<u4")
                rows.append((*base_counts(t), len(ids), *_fertility(t, ids, pieces.is_byte),
                             script_of(t)))
        cols = list(zip(*rows)) or [[]] * 10
        names = [f.split()[0] for f in BASE_SCHEMA.split(", ")] + ["n_tokens"]
        fields = {n: (c, pa.int64()) for n, c in zip(names, cols)}
        fields |= {n: (c, pa.float64()) for n, c in zip(MEASURES, cols[6:9])}
        return struct_array(fields | {"script": (cols[9], pa.string())})
    return measure(text)


#: classes of token counts per doubling, and the last one
CLASSES_PER_OCTAVE, LAST_CLASS = 2, 64
#: least distance of a band's end from its quartile, and what a text may stray further, in tokens
LEAST_REACH = {"chars_per_token": 0.03, "fallback_share": 0.02, "entropy_share": 0.01}
TOKEN_SLACK = {"chars_per_token": 0.0, "fallback_share": 8.0, "entropy_share": 0.0}
#: rows that the neighbours of a class count for at most, and the share that is left per class away
NEAR_ROWS, NEAR_SHARE = 50.0, 0.35
#: rows that the script's band counts for beside a language's own
SCRIPT_ROWS = 5.0
#: rows times squared classes that the slope over the classes is held back by
FLAT_ROWS = 100.0


def class_of(n_tokens: Column) -> Column:
    """Class of a token count: half of a doubling each."""
    return F.least(F.floor(CLASSES_PER_OCTAVE * F.log2(F.greatest(n_tokens, F.lit(1)))),
                   F.lit(LAST_CLASS)).cast("int")


def class_bands(cls: np.ndarray, bins: np.ndarray, n: np.ndarray, wanted: np.ndarray, unit: float,
                least: float, spread: float) -> np.ndarray:
    """``rows, low, high`` of each wanted class, from the binned counts of one group and measure.

    A class learns from its own counts and, for ``NEAR_ROWS`` rows at most, from those of its
    neighbours, moved along the group's slope over the classes: the measures depend on the length. So
    rare classes lean on the others, and one odd text doesn't make its own band. A band ends
    ``spread`` times the distance from the median to the quartile beyond each quartile, further where
    it rests on few rows.
    """
    def quantiles(at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        order = np.argsort(at, kind="stable")
        upto = np.cumsum(weight[order])
        # rows lie evenly within their bin
        found = np.minimum(np.searchsorted(upto, np.array([0.25, 0.5, 0.75]) * upto[-1]), len(at) - 1)
        into = 1 - (upto[found] - np.array([0.25, 0.5, 0.75]) * upto[-1]) / weight[order][found]
        return (at[order][found] + np.clip(into, 0, 1)) / unit

    kinds, index = np.unique(cls, return_inverse=True)
    rows = np.bincount(index, weights=n)
    middle = np.array([quantiles(bins[index == k].astype(float), n[index == k].astype(float))[1]
                       for k in range(len(kinds))])
    off = kinds - np.average(kinds, weights=rows)
    slope = (rows * off * (middle - np.average(middle, weights=rows))).sum() / ((rows * off ** 2).sum() + FLAT_ROWS)
    out = []
    for c in wanted:
        near = n * NEAR_SHARE ** np.abs(cls - c) * (cls != c)
        others = n[cls != c].sum()
        if others:
            # relative to the nearest class, so that a far one doesn't vanish
            near = near / near.sum() * NEAR_ROWS * others / (others + NEAR_ROWS)
        weight = np.where(cls == c, n, near).astype(float)
        q1, q2, q3 = quantiles(bins + (c - cls) * slope * unit, weight)
        few = 1 + 2 / np.sqrt(weight.sum())
        out.append((int(n[cls == c].sum()), q1 - max(spread * (q2 - q1), least) * few,
                    q3 + max(spread * (q3 - q2), least) * few))
    return np.array(out).reshape(-1, 3)


def _learned(table: pa.Table, spread: float, every: bool) -> pa.Table:
    """The bands of one group from its counts; of ``every`` class, or of those it has."""
    cls, at, bins, n = (table[c].to_numpy() for c in ("class", "at", "bin", "n"))
    wanted = np.arange(LAST_CLASS + 1) if every else np.unique(cls)
    cols = {"class": wanted.astype(np.int32)}
    for k, m in enumerate(MEASURES):
        own = at == k
        made = class_bands(cls[own], bins[own], n[own], wanted, BINS[m], LEAST_REACH[m], spread)
        cols |= {f"{m}_low": made[:, 1], f"{m}_high": made[:, 2]}
    group = pa.array([table["group"][0].as_py()] * len(wanted), pa.string())
    rows = pa.array([int(n[at == 0].sum())] * len(wanted), pa.int64())
    return pa.table({"group": group, "rows": rows} | {c: pa.array(v) for c, v in cols.items()})


_ENDS = ", ".join(f"{m}_low double, {m}_high double" for m in MEASURES)


def fertility_bands(rows: DataFrame, spread: float = 4.0) -> DataFrame:
    """``group, class`` and the low and high ends of each measure: the bands, written once.

    ``rows`` has ``group``, ``script``, ``n_tokens`` and the measures of the documents to learn from.
    Every group has its own bands, whatever its size. The ends move towards those of all documents of
    the script that most of its texts are in, which weigh as much as ``SCRIPT_ROWS`` of its rows.
    Measures are counted in bins first, so whatever the rows, few counts per group are sorted.
    """
    bins = F.array(*[F.floor(F.col(m) * BINS[m]) for m in MEASURES])
    counts = materialize(rows.select("group", "script", class_of(F.col("n_tokens")).alias("class"),
                                     F.posexplode(bins).alias("at", "bin"))
                         .groupBy("group", "script", "class", "at", "bin").agg(F.count("*").alias("n")), "counts")

    def learned(key: str, every: bool) -> DataFrame:
        return (counts.groupBy(F.col(key).alias("group"), "class", "at", "bin").agg(F.sum("n").alias("n"))
                .groupBy("group").applyInArrow(lambda t: _learned(t, spread, every),
                                               f"group string, rows long, class int, {_ENDS}"))

    script_of_group = (counts.where("at = 0").groupBy("group", "script").agg(F.sum("n").alias("n"))
                       .groupBy("group").agg(F.min_by("script", F.struct(-F.col("n"), "script")).alias("_script")))
    ends = [f"{m}_{end}" for m in MEASURES for end in ("low", "high")]
    by_script = learned("script", True).select(F.col("group").alias("_script"), "class",
                                               *[F.col(c).alias(f"_{c}") for c in ends])
    share = F.col("rows") / (F.col("rows") + SCRIPT_ROWS)
    bands = materialize(
        learned("group", False).join(script_of_group, "group").join(by_script, ["_script", "class"])
        .select("group", "class", *[(share * F.col(c) + (1 - share) * F.col(f"_{c}")).alias(c) for c in ends]), "bands")
    forget(counts)
    return bands


def judge(docs: DataFrame, model: str, text_col: str = "text", lang_col: str | None = "lang",
          carry: list[str] | None = None, verdict: str = "_verdict", spread: float = 4.0) -> DataFrame:
    """The carried columns of every row (all by default) and a struct column with its verdict.

    The struct has the base counts, the three measures, ``base_failed`` and ``kept``: whether the
    base rule holds and every measure lies in the band of the row's class of token counts in its
    language, or in its script where the language is null. The fewer documents of a group pass the base rule, the wider its bands and the
    nearer to those of its script. A null text has no words and fails; without any passing document nothing is
    kept. Repeated rows are judged alike, one by one. The carried columns may have any names but that of
    the verdict. They and the measures are written once to the shared folder.
    """
    carry = docs.columns if carry is None else carry
    if verdict in carry:
        raise ValueError(f"the rows have a column {verdict} of their own")
    script = F.concat(F.lit("script "), F.col("_m.script"))
    group = (F.coalesce(F.concat(F.lit("lang "), F.col("_lang").cast("string")), script)
             if lang_col else script)
    rows = materialize(docs.select(
        row_of(carry).alias("_row"), measured(F.col(f"`{text_col}`"), model).alias("_m"),
        (F.col(f"`{lang_col}`") if lang_col else F.lit(None)).alias("_lang"))
        .withColumn("_group", group).drop("_lang"), "fertility")
    failed = ((F.col("_m.n_words") < LEAST_WORDS)
              | (100 * F.col("_m.n_repeat_words") > MOST_REPEATED * F.col("_m.n_words")))
    bands = fertility_bands(rows.where(~failed).select(
        F.col("_group").alias("group"), F.col("_m.script").alias("script"), F.col("_m.n_tokens").alias("n_tokens"),
        *[F.col(f"_m.{m}").alias(m) for m in MEASURES]), spread)
    ends = F.struct(*[f"{m}_{end}" for m in MEASURES for end in ("low", "high")])
    by_class = bands.select(F.col("group").alias("_group"), F.col("class").alias("_class"), ends.alias("_ends"))
    if bands.count() <= SMALL_BANDS:  # else too many languages to send to every task
        by_class = F.broadcast(by_class)

    def inside(m: str) -> Column:
        slack = F.lit(TOKEN_SLACK[m]) / F.greatest(F.col("_m.n_tokens"), F.lit(1))
        return F.coalesce((F.col(f"_m.{m}") >= F.col("_ends")[f"{m}_low"] - slack)
                          & (F.col(f"_m.{m}") <= F.col("_ends")[f"{m}_high"] + slack), F.lit(False))

    kept = ~failed & inside(MEASURES[0]) & inside(MEASURES[1]) & inside(MEASURES[2])
    return (rows.withColumn("_class", class_of(F.col("_m.n_tokens")))
            .join(by_class, ["_group", "_class"], "left")
            .select("_row", F.col("_m").withField("base_failed", failed).withField("kept", kept).alias("_v"))
            .select("_row.*", F.col("_v").alias(verdict)))
