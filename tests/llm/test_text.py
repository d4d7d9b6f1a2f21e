"""Operators that look at each text by itself, against the libraries or plain versions."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessella.llm import cutting, fertility, langid, packing, pieces, quality, tokencounts
from tessella.llm.common import remainder
from tessella.llm.queries import BYTE_RANKS, PIECES

TEXTS = ["", None, " ", "a", "a ", " a", "  a  b ", "▁", "a▁ ▁b", "a\x00b", "a\nb\t c\r\n", "é́ 漢字 🙂x",
         "<s> </s> <unk> <|endoftext|>", "x" * 3000 + " y", "\x1c a\x85b  c\xa0d", "the cat's 12 hats!!",
         "wörd " * 5000, "The\n\n\n  end. ", "日本語" * 400]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1.0) for i, t in enumerate(TEXTS)] + [(3, "a", "x", 1.0), (None, "b", None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, score double")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_sentencepiece_equals_the_library(docs, empty):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.round_trip_digests(docs, PIECES).collect()
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = "b" if row["doc_id"] is None else TEXTS[row["doc_id"]] or ""
        ids = model.encode(text, add_bos=True, add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text
        assert row["decoded_sha256"] == hashlib.sha256(model.decode(ids).encode()).hexdigest()
    assert pieces.round_trip_digests(empty, PIECES).count() == 0


def test_piece_ids_and_back(docs):
    ids = pieces.piece_ids(F.col("text"), PIECES)
    got = docs.where("doc_id is not null").select("text", pieces.piece_texts(ids, PIECES).alias("back")).collect()
    assert all(r["back"] == (r["text"] or "").replace("▁", " ") for r in got)


def test_piece_table_forgets_and_agrees():
    small, large = pieces.PieceTable(PIECES, limit=3), pieces.PieceTable(PIECES)
    texts = [t or "" for t in TEXTS]
    assert small.ids(texts) == large.ids(texts) == [large.ids([t])[0] for t in texts]


def test_token_counts_equal_a_plain_search(docs, empty):
    costs = tokencounts.piece_costs(BYTE_RANKS)
    longest = max(map(len, costs))

    def plain(word):
        best = [0]
        for end in range(1, len(word) + 1):
            best.append(min(best[start] + costs[word[start:end]] for start in range(max(0, end - longest), end)
                            if word[start:end] in costs))
        return best[-1] % tokencounts.PIECE

    got = tokencounts.token_counts(docs, BYTE_RANKS).collect()
    for row in got:
        text = "b" if row["doc_id"] is None else TEXTS[row["doc_id"]] or ""
        words = re.findall(r"\s*\S+|\s+", text)
        assert row["n_bytes"] == len(text.encode()) and row["n_pretokens"] == len(words)
        assert row["n_tokens"] == sum(plain(w.encode()) for w in words), text[:20]
    assert tokencounts.token_counts(empty, BYTE_RANKS).count() == 0


def test_language_of_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate(
        [("the house and the garden of the king", "en"), ("das Haus und der Garten des Königs", "de")] * 20)]
    rows += [(100, None, "en"), (101, "1234 !!", "en"), (102, "", None), (103, "the garden", None),
             (104, "DER GARTEN", None), (105, "the king " * 200_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_language_model(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    got = {r["doc_id"]: r["p"] for r in docs.select(
        "doc_id", langid.predict_language(F.col("text"), model, spark).alias("p")).collect()}
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103, 104, 105)] == ["und"] * 3 + ["en", "de", "en"]
    assert all(0 <= p["score"] <= 1 for p in got.values())
    none = langid.fit_language_model(docs.limit(0), F.col("text"), F.col("lang"), F.col("doc_id"))
    assert none.languages == []
    assert docs.select(langid.predict_language(F.col("text"), none, spark).lang_pred).distinct().first()[0] == "und"


def plain_grams(text, buckets):
    """Bucket of every 1- to 3-gram of a text."""
    lower = re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text.lower()))
    points = [32, *map(ord, lower), 32]
    for n in (1, 2, 3):
        for at in range(len(points) - n + 1):
            value = n
            for p in points[at:at + n]:
                value = (value ^ p) * 0x9E3779B97F4A7C15 % 2 ** 64
                value ^= value >> 29
            yield value % buckets


def test_language_equals_a_plain_model(spark):
    rng = np.random.default_rng(4)
    alphabets = {"x": "abcdef", "y": "defghi", "z": "ghiéa1 "}
    rows = [(i, "".join(rng.choice(list(alphabets[lang]), int(rng.integers(1, 60)))), lang)
            for i, lang in enumerate(rng.choice(list(alphabets), 60).tolist())]
    rows += [(60, rows[0][1], "x"), (61, rows[0][1], "y"), (62, None, "x"), (63, "no language", None), (64, "", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    buckets, smoothing = 256, 0.1
    counts = {k: np.zeros(buckets) for k in alphabets}
    texts = dict.fromkeys(alphabets, 0)
    for _, text, lang in rows:
        if text is not None and lang is not None:
            texts[lang] += 1
            for b in plain_grams(text, buckets):
                counts[lang][b] += 1
    model = langid.fit_language_model(docs, F.col("text"), F.col("lang"), F.col("doc_id"), buckets, smoothing)
    got = docs.select("doc_id", langid.predict_language(F.col("text"), model, spark).alias("p")).collect()
    for row, (_, text, _) in zip(sorted(got), rows):
        if text is None or not any(map(str.isalpha, text)):
            assert tuple(row["p"]) == ("und", 0.0)
            continue
        log = {}
        for lang in alphabets:
            prob = np.log((counts[lang] + smoothing) / (counts[lang] + smoothing).sum())
            log[lang] = np.log(texts[lang] / sum(texts.values())) + sum(prob[b] for b in plain_grams(text, buckets))
        best = max(sorted(log), key=log.get)
        assert row["p"]["lang_pred"] == best
        assert row["p"]["score"] == pytest.approx(1 / sum(np.exp(v - log[best]) for v in log.values()))


def test_equal_languages_and_very_many(spark):
    rows = [(i, "same text", lang) for i, lang in enumerate(["b", "a", "c"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_language_model(docs, F.col("text"), F.col("lang"), F.col("doc_id"))
    assert docs.select(langid.predict_language(F.col("text"), model, spark).lang_pred).distinct().collect() == [("a",)]
    many = spark.createDataFrame([(i, chr(0x4E00 + i) * 9, f"l{i}") for i in range(300)], docs.schema)
    model = langid.fit_language_model(many, F.col("text"), F.col("lang"), F.col("doc_id"), max_cells=300 << 12)
    assert len(model.languages) == 300 and len(model.log_prob) == 1 << 12
    got = many.select("lang", langid.predict_language(F.col("text"), model, spark).lang_pred.alias("p"))
    assert got.where("lang = p").count() >= 270


def test_sparse_product_in_steps(monkeypatch):
    texts = ["abc abd", "", "xyz " * 50, "abc"]
    rng = np.random.default_rng(0)
    model = langid.LanguageModel(["p", "q"], rng.normal(size=(64, 2)), np.array([0.5, 0.25]))
    whole = langid._score(model, texts)
    want = [model.log_prior + sum(model.log_prob[g] for g in plain_grams(t, 64)) for t in texts]
    assert np.allclose(whole, want)
    monkeypatch.setattr(langid, "BATCH_GRAMS", 10)
    monkeypatch.setattr(langid, "PRODUCT_CELLS", 6)
    assert np.allclose(langid._score(model, texts), want)


def test_language_windows_lose_no_gram(monkeypatch):
    text = "Every gram of a long text counts, wherever a window ends."
    whole = np.sort(np.concatenate(list(langid._windows(text, 1 << 15))))
    monkeypatch.setattr(langid, "WINDOW", 7)
    assert (np.sort(np.concatenate(list(langid._windows(text, 1 << 15)))) == whole).all()


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += line in seen and bool(re.search(r"[^\x20\x09-\x0D]", line))
        seen.add(line)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


REPEATED = ["a b c d e f g h " * 3, "x\nx\n\n \nx\n y\n y", " ".join(str(i % 9) for i in range(40)),
            "one two three four five six seven eight nine " + " ".join("two three four five six seven eight nine".split())]


@pytest.mark.parametrize("text", TEXTS + REPEATED + ["a|b <c> #%$ & *\x0b\x0c"])
def test_base_counts(text):
    assert fertility.base_counts(text or "") == plain_base(text)


def test_fertility_verdicts(spark, docs, empty):
    rng = np.random.default_rng(0)
    common = "the of and to in house garden water people number sound great where after thing".split()
    rows = [(i, " ".join(rng.choice(common, 60)), "en") for i in range(300)]
    rows += [(1000, " ".join("".join(map(chr, rng.integers(0x4E00, 0x9000, 4))) for _ in range(60)), "en"), (1001, "too short", "en"), (1002, None, None),
             (1003, "#*$% " * 60, "en"), (1004, " ".join(rng.choice(common, 60)), None)]
    mixed = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["_verdict"] for r in fertility.judge(mixed, PIECES, carry=["doc_id"]).collect()}
    assert sum(got[i]["kept"] for i in range(300)) == 300 and got[1004]["kept"]
    assert not any(got[i]["kept"] for i in (1000, 1001, 1002, 1003))
    assert got[1001]["base_failed"] and not got[1000]["base_failed"] and got[1003]["base_failed"]
    same = fertility.judge(docs, PIECES, lang_col=None)
    assert same.columns == docs.columns + ["_verdict"] and same.count() == docs.count()
    assert fertility.judge(empty, PIECES, lang_col=None).count() == 0


SYLLABLES = {"en": "th he in er an re on at en nd ti es or te of ed is it al ar", "de": "er en ch de ei ie in te ge un nd sch be st ver ung",
             "es": "de la que el en os as ci ón es ar do ra men to ad", "fr": "le es ent de la ou re ai eu é tion qu ux en an ment"}


def prose(rng, lang, n):
    parts = SYLLABLES[lang].split()
    return ["".join(rng.choice(parts, int(rng.integers(1, 5)))) for _ in range(n)]


def junk(rng, lang, n, table):
    marks = ["***", "%%%", "&&&", "$$$"]
    return " | ".join(prose(rng, lang, n)) if table else " ".join(w + str(rng.choice(marks)) for w in prose(rng, lang, n))


def test_fertility_bands_reject_junk_of_any_length(spark):
    rng = np.random.default_rng(4)
    rows = []
    for lang in SYLLABLES:
        rows += [(f"{lang} clean {i}", " ".join(prose(rng, lang, int(rng.integers(30, 600)))), lang) for i in range(300)]
        rows += [(f"{lang} junk {i}", junk(rng, lang, int(rng.integers(40, 600)), i % 2), lang) for i in range(16)]
    got = fertility.judge(spark.createDataFrame(rows, "doc_id string, text string, lang string"), PIECES, carry=["doc_id"])
    kept = [r["doc_id"] for r in got.where("_verdict.kept").select("doc_id").collect()]
    assert not got.where("_verdict.base_failed").count()
    for lang in SYLLABLES:
        assert sum(k.startswith(f"{lang} clean") for k in kept) >= 290
        assert sum(k.startswith(f"{lang} junk") for k in kept) <= 2


def test_fertility_bands_of_small_groups(spark):
    rng = np.random.default_rng(5)
    han, thai = [chr(0x4E00 + 7 * i) for i in range(60)], "ก ข ค ง จ ช ซ ด ต ท น บ ป พ ม ย ร ล ว ส ห อ า ิ ี เ แ".split()

    def spaced(letters):
        return " ".join("".join(rng.choice(letters, int(rng.integers(3, 9)))) for _ in range(int(rng.integers(40, 200))))

    def clean(lang):
        return " ".join(prose(rng, lang, int(rng.integers(30, 300))))

    rows = [(f"en {i}", clean("en"), "en") for i in range(600)] + [(f"es {i}", clean("es"), "es") for i in range(60)]
    rows += [(f"es junk {i}", junk(rng, "es", int(rng.integers(40, 200)), i % 2), "es") for i in range(6)]
    rows += [(f"zh {i}", spaced(han), "zh") for i in range(30)] + [(f"null {i}", spaced(thai), None) for i in range(25)]
    rows += [("fr 0", clean("fr"), "fr"), ("de 0", clean("de"), "de"), ("th 0", spaced(thai), "th")]
    got = fertility.judge(spark.createDataFrame(rows, "doc_id string, text string, lang string"), PIECES, carry=["doc_id"])
    kept = [r["doc_id"] for r in got.where("_verdict.kept").select("doc_id").collect()]
    assert sum("junk" in k for k in kept) <= 2
    assert [sum(k.startswith(f"{g} ") and "junk" not in k for k in kept) for g in ("zh", "null", "fr", "de", "th")] == [30, 25, 1, 1, 1]
    assert sum(k.startswith("es ") and "junk" not in k for k in kept) >= 58


def test_scripts():
    assert [fertility.script_of(t) for t in ("", "abc", "абв", "漢字", "ひら", "12", "한국")] == [
        "none", "Latin", "Cyrillic", "Han", "Kana", "none", "Hangul"]


def test_quality_separates_and_is_monotone(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        good = i % 2
        words = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(40)]
        rows.append((i, " ".join(words) + "." if good else "!! ".join(w.upper() for w in words), good, i % 4 == 1))
    docs = spark.createDataFrame(rows, "key long, text string, y int, calibrate boolean")
    stats = docs.select("key", quality.statistics_of(F.col("text")).alias("x"), "y", (F.col("key") % 5 == 0).alias("calibrate"))
    model = quality.fit_quality_model(stats)
    got = stats.select("y", quality.quality_score(F.col("x"), model, spark).alias("s")).toPandas()
    assert got.s.between(0, 1).all() and got[got.y == 1].s.min() > 0.7 > 0.3 > got[got.y == 0].s.max()
    assert (np.diff(model.levels) >= 0).all()
    none = quality.fit_quality_model(stats.limit(0))
    assert set(none.score(np.zeros((2, len(quality.STATISTICS))))) == {0.5}
    odd = docs.limit(1).select(F.explode(F.array(*[F.lit(t).cast("string") for t in TEXTS if t != "a\x00b"])).alias("t"))
    scores = odd.select(quality.quality_score(quality.statistics_of(F.col("t")), model, spark)).toPandas().iloc[:, 0]
    assert scores.between(0, 1).all()


def test_quality_equals_a_plain_fit(spark):
    """Normal equations, ridge and calibration against dense formulas over all rows."""
    rng = np.random.default_rng(8)
    width = len(quality.STATISTICS)
    x = rng.normal(size=(300, width))
    y = (x[:, 0] + 0.5 * rng.normal(size=300) > 0).astype(int)
    fits = np.arange(300) % 3 != 0
    rows = spark.createDataFrame([(i, x[i].tolist(), int(y[i]), bool(not fits[i])) for i in range(300)],
                                 "key long, x array<double>, y int, calibrate boolean").repartition(5)
    model = quality.fit_quality_model(rows, n_features=16, n_bins=64)
    assert np.allclose(model.mean, x[fits].mean(axis=0)) and np.allclose(model.scale, x[fits].std(axis=0))
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    f = np.hstack([np.ones((300, 1)), z, np.sqrt(2 / 16) * np.cos(z @ model.frequency + model.phase)])
    penalty = np.eye(f.shape[1]) * 1e-3 * fits.sum()
    penalty[0, 0] = 1e-9
    weight = np.linalg.solve(f[fits].T @ f[fits] + penalty, f[fits].T @ y[fits])
    assert np.allclose(model.weight, weight)
    # isotonic regression: the largest of the least means around each bin
    ridge = f @ weight
    bins = np.floor(np.clip(ridge[~fits], -0.5, 1.5) * 32).astype(int)
    kinds = np.unique(bins)
    n, p = (np.array([np.sum(w[bins == b]) for b in kinds]) for w in (np.ones((~fits).sum()), y[~fits]))
    level = [max(min(p[a:b].sum() / n[a:b].sum() for b in range(i + 1, len(n) + 1)) for a in range(i + 1)) for i in range(len(n))]
    at_bins = np.interp((kinds + 0.5) / 32, model.knots, model.levels)
    for value in np.unique(level):  # a block of bins has its level at its centre
        own = np.array(level) == value
        centre = np.average((kinds[own] + 0.5) / 32, weights=n[own])
        assert np.interp(centre, model.knots, model.levels) == pytest.approx(value)
    assert (np.diff(at_bins) >= -1e-12).all()
    assert np.allclose(model.score(x), np.clip(np.interp(ridge, model.knots, model.levels), 0, 1))
    plain = quality.fit_quality_model(rows.where("not calibrate"), n_features=16)
    assert not len(plain.knots) and np.allclose(plain.score(x), np.clip(plain.ridge(x), 0, 1)) and plain.score(x).std() > 0.1


def test_isotonic_pools_violators():
    knots, levels = quality.isotonic(np.arange(5.0), np.array([0, 2, 1, 3, 4]), np.full(5, 4))
    assert (np.diff(levels) > 0).all() and levels.tolist() == [0, 0.375, 0.75, 1.0] and knots[1] == 1.5


def test_patterns_use_up_the_demand():
    rng = np.random.default_rng(2)
    for size, demand in ((np.arange(1, 33), rng.integers(0, 50, 32)), (np.array([20, 33]), np.array([7, 9])),
                         (np.array([], int), np.array([], int)), (np.array([64]), np.array([3]))):
        size, demand = size[demand > 0], demand[demand > 0]
        plan = cutting.stock_plan(size, demand, 64)
        used = {int(s): 0 for s in size}
        for counts, times in plan:
            assert times > 0 and sum(s * n for s, n in counts.items()) <= 64
            for s, n in counts.items():
                used[s] += n * times
        assert used == dict(zip(size.tolist(), demand.tolist()))


def test_best_pattern_equals_all_patterns():
    value, size = np.array([0.2, 0.55, 0.6]), np.array([2, 5, 6])
    worth, counts = cutting.best_pattern(value, size, 13)
    every = [(a * .2 + b * .55 + c * .6) for a in range(7) for b in range(3) for c in range(3)
             if 2 * a + 5 * b + 6 * c <= 13]
    assert worth == pytest.approx(max(every)) and counts @ size <= 13 and counts @ value == pytest.approx(worth)


SPECIAL_TEXTS = ["<|endoftext|>", "hello <|endoftext|>", "a<|endoftext|> <|endoftext|><|endoftext|>b  <|endoftext|>\n c",
                 "<|endoftext| >", "x  <|endoftext|>  y<|endoftext"]


def test_packing(spark, docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = packing.special_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(enumerate(TEXTS)) | {1000 + i: t for i, t in enumerate(SPECIAL_TEXTS)}
    del texts[3]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(SPECIAL_TEXTS)], "doc_id long, text string")
    rows = docs.where("doc_id <> 3").select("doc_id", "text").union(more)
    got = packing.pack(rows, BYTE_RANKS, special=special).toPandas()
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = got[got["id"] == i].sort_values("start")
        assert own["length"].sum() == len(ids) and set(own["doc_tokens"]) == {len(ids)}
        at = 0
        for _, p in own.iterrows():
            assert p["start"] == at and p["ids_crc32"] == zlib.crc32(ids[at:at + p["length"]].tobytes()), (i, text)
            at += p["length"]
    for _, sequence in got.sort_values("offset").groupby("sequence_id"):
        assert sequence["length"].sum() <= 2048
        assert sequence["offset"].tolist() == [0, *sequence["length"].cumsum().tolist()[:-1]]
    assert packing.pack(docs, BYTE_RANKS).count() == len(got) + 3 - len(SPECIAL_TEXTS)
    assert packing.pack(empty, BYTE_RANKS).count() == 0


def test_special_tokens_are_plain_text_unless_named():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    made = packing.ByteTable(BYTE_RANKS).ids(SPECIAL_TEXTS)
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in SPECIAL_TEXTS]


def test_remainder_is_crc32_of_the_text(spark):
    got = spark.range(-3, 200).union(spark.createDataFrame([(None,)], "id long")).select(
        "id", remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r["r"] == (-1 if r["id"] is None else zlib.crc32(str(r["id"]).encode()) % 5) for r in got)


def test_verdicts_keep_any_columns(spark):
    rows = spark.createDataFrame([("a b c " * 20, "en", *range(8))],
                                 "text string, lang string, _m int, _lang int, _ends int, _group int, _class int, _row int, _v int, script int")
    got = fertility.judge(rows, PIECES)
    assert got.columns == [*rows.columns, "_verdict"] and tuple(got.first())[:10] == tuple(rows.first())
    with pytest.raises(ValueError):
        fertility.judge(rows, PIECES, verdict="_m")
