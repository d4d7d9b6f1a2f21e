"""Ranked lexical search and hard negatives, against plain versions."""

import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import lexical, negatives


def plain_terms(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain_search(docs, items, k):
    bags = [(i, collections.Counter(plain_terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    wanted = collections.defaultdict(set)
    for i, t in items:
        if i is not None:
            wanted[i] |= set(plain_terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 20 * m))
                    for t in own if t in bag)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("seed,block_pairs", [(0, 200_000), (1, 20)])
def test_ranked_search(spark, monkeypatch, seed, block_pairs):
    rng = np.random.default_rng(seed)
    words = ["The", "a", "é", "Éa", "x1", "漢字", "ÀB", "z q"] + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choice(words, int(rng.integers(1, 30)))) + rng.choice(["", "!", "-the"])) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(90)] + [(1000, docs[3][1]), (None, "the w1"), (None, "the w1"),
             (7, None), (8, ""), (9, " ,;"), (2000, "w5 " * 4000), (-4, "THE w1")]
    items = [(i, " ".join(rng.choice(words, int(rng.integers(1, 8))))) for i in range(12)]
    items += [(3, "w7 w8"), (50, None), (51, ""), (None, "the"), (52, "unseen"), (53, "THE the")]
    monkeypatch.setattr(lexical, "TILE_CELLS", 64)
    monkeypatch.setattr(lexical, "KEPT_ROWS", 10)
    monkeypatch.setattr(lexical, "TEXT_BYTES", 50)
    d = spark.createDataFrame([(*r, 1, "h") for r in docs], "doc_id long, text string, score int, bag string").repartition(3)
    i = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, item int")
    got = lexical.ranked_search(d, i, 20, block_pairs=block_pairs).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_search(docs, items, 20)


def test_ranked_search_tells_bags_apart_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "_marks", lambda bag: [F.lit(1).cast("long").alias("h1"), F.lit(2).cast("long").alias("h2")])
    docs = [(i, f"a{i % 3} b{i % 4} c") for i in range(40)]
    items = [(0, "a0 b1"), (1, "a1 c")]
    got = lexical.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_search(docs, items, 10)


def test_ranked_search_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0)), (docs, items.selectExpr("item_id", "'q' text"))):
        assert lexical.ranked_search(d, i).count() == 0
    assert [tuple(r)[:3] for r in lexical.ranked_search(docs, items).collect()] == [(1, 1, 1)]


def test_terms_are_not_cut(monkeypatch):
    monkeypatch.setattr(lexical, "TEXT_BYTES", 3)
    text = "abcdefgh ij é漢字k, l1 M"
    assert [t.decode() for part in lexical.terms(text.encode()) for t in part] == plain_terms(text)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2)])
def test_hilbert_curve_steps_to_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    place = negatives.hilbert_index(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    rng = np.random.default_rng(0)
    a, x = np.floor(rng.normal(0, 50, (5, 7))), np.floor(rng.normal(0, 50, (40, 7)))
    least, most = negatives._bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    score = a @ x.T
    assert (least <= score).all() and (score <= most).all()


def plain_negatives(rows, scale, every):
    best = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(v is None or not math.isfinite(v) for v in vec):
            continue
        whole = [math.floor(scale * v) for v in vec]
        best[i] = min(best.get(i, (label, whole)), (label, whole))
    out = []
    for i, (label, vec) in best.items():
        if i % every:
            continue
        scores = sorted((-max(-negatives.LONG, min(negatives.LONG, sum(a * b for a, b in zip(vec, v)))), j, own)
                        for j, (own, v) in best.items() if j != i)
        for s, j, _ in [x for x in scores if x[2] == label][:5]:
            bad = [x for x in scores if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(bad, 1)]
    return sorted(out)


@pytest.mark.parametrize("seed,block_rows,huge", [(0, 4096, False), (1, 16, False), (2, 25, True)])
def test_hard_negatives(spark, monkeypatch, seed, block_rows, huge):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 1, (4, 6))
    rows = [(i, int(rng.integers(0, 4)), (centre[i % 4] + rng.normal(0, 0.4, 6)).tolist()) for i in range(260)]
    rows += [(300 + i, i % 2, rows[10][2]) for i in range(60)]  # one vector very often
    rows += [(None, 1, [1.0] * 6), (400, None, [1.0] * 6), (401, 1, None), (402, 1, [1.0, None]), (403, 1, [float("nan")] * 6),
             (404, 1, [float("inf")] * 6), (405, 2, []), (406, 2, [0.5, 0.25]), (410, 9, [1.0] * 6), (10, 0, rows[3][2]), (20, 1, rows[20][2])]
    if huge:
        rows += [(500 + i, i % 2, (rng.normal(0, 1, 6) * 1e9).tolist()) for i in range(20)]
    monkeypatch.setattr(negatives, "ZONE_GROUP", 4)
    monkeypatch.setattr(negatives, "ANCHOR_GROUP", 5)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, label int, embedding array<double>, block int, grp string")
    got = negatives.hard_negatives(df.repartition(3), F.col("id") % 10 == 0, "vec_id", "embedding", "label", 256.0, block_rows=block_rows)
    want = plain_negatives(rows, 256.0, 10)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_hard_negatives_of_few_rows(spark):
    df = spark.createDataFrame([(0, 1, [1.0]), (1, 1, [0.5]), (2, 2, [0.4])], "id long, label int, vec array<double>")
    got = negatives.hard_negatives(df, F.col("id") == 0, scale=10.0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 2, 50, 40)]
    for few in (df.limit(0), df.where("id > 0"), df.where("label = 2 or id = 0")):
        assert negatives.hard_negatives(few, F.col("id") == 0).count() == 0


def test_few_blocks_are_read(spark):
    """Anchors in far clusters read the blocks of their own surroundings only."""
    rng = np.random.default_rng(3)
    centre = rng.choice([-100.0, 100.0], (16, 8))
    rows = [(i, i % 2, np.floor(centre[i % 16] + rng.normal(0, 3, 8)).tolist()) for i in range(1600)]
    blocks = negatives._ordered(spark.createDataFrame(rows, "id long, label long, vec array<double>"), 8, 1600, 100)
    zones = negatives._zone_maps(blocks, 8)
    anchors = blocks.where("id % 50 = 0").withColumnRenamed("block", "grp")
    search = negatives._Search(blocks, zones, anchors, 8, 5, 3, (50, 95))
    least = anchors.withColumn("least", F.array(F.lit(8 * 97 * 97).cast("long"))).withColumn("last", F.lit(negatives.LONG))
    assert search.chosen(least, False).count() <= 0.4 * anchors.count() * zones.count()
