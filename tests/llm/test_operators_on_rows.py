"""Operators on several rows, against brute force."""

import collections
import hashlib
import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessella.llm import graph, ngramjoin, topk, urlfilter, warc
from tessella.llm.common import materialize
from tessella.llm.graph import components


def roots(nodes, edges):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(30)], [(i + 1, i) for i in range(0, 40, 2)] + [(5, 9), (9, 30)],
    [(0, i) for i in range(1, 50)] + [(7, -3)]])
def test_components(spark, edges):
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert got == roots({n for e in real for n in e}, real)


@pytest.mark.parametrize("small", [0, 1 << 15])
def test_components_of_few_and_many_edges(spark, monkeypatch, small):
    """A chain of stars either way; with few edges a round writes one table."""
    edges = [(10 * i, 10 * i + 10) for i in range(12)] + [(10 * i, 10 * i + k) for i in range(12) for k in range(1, 6)] + [(500, 501)]
    written = []
    monkeypatch.setattr(graph, "SMALL_EDGES", small)
    monkeypatch.setattr(graph, "materialize", lambda df, name: written.append(name) or materialize(df, name))
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots({n for e in edges for n in e}, edges)
    assert (set(written) == {"edges"}) == bool(small)


def plain_components(rows, words, percent):
    sets = {}
    for i, text in rows:
        found = (text or "").encode().lower().split()
        width = min(words, len(found))
        sets[i] = {tuple(found[j:j + width]) for j in range(len(found) - width + 1)} if found else set()
    ids = sorted(sets)
    edges = []
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                edges.append((a, b))
    top = roots(ids, edges)
    return {i: (len(sets[i]), top[i]) for i in ids}


def near_copies(seed, families=12, size=9):
    """Texts of many lengths with copies that differ by a few words, and one passage in most."""
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(rng.choice(vocabulary, 25))
    rows = []
    for _ in range(families):
        base = list(rng.choice(vocabulary, int(rng.integers(1, 140))))
        for _ in range(size):
            text = list(base)
            for _ in range(int(rng.integers(0, 5))):
                text[int(rng.integers(len(text)))] = str(rng.choice(vocabulary))
            rows.append(" ".join(text) + (" " + passage if rng.random() < 0.5 else ""))
    rows += ["", None, " \n ", "One", "one", "one two", "ONE\ttwo", "a b c", "a b c a b c"]
    return [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows)]


@pytest.mark.parametrize("seed,words,percent", [(0, 3, 90), (1, 5, 80), (2, 1, 60), (3, 2, 100)])
def test_jaccard_components(spark, seed, words, percent):
    rows = near_copies(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, n string, component int")
    got = ngramjoin.jaccard_components(docs.union(docs.limit(5)), words, percent).collect()
    assert len(got) == len(rows) + 5
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == plain_components(rows, words, percent)


def test_jaccard_blocks_of_one_family(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK_GRAMS", 400)
    monkeypatch.setattr(ngramjoin, "SMALL_GROUP", 3)
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        text = list(base)
        for _ in range(int(rng.integers(0, 7))):
            text[int(rng.integers(80))] = f"x{rng.integers(1000)}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngramjoin.jaccard_components(docs, 3, 90).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == plain_components(rows, 3, 90)


def test_jaccard_small_blocks_of_few_sets(spark, monkeypatch):
    for name, value in (("SMALL_GROUP", 3), ("BLOCK_SETS", 7), ("STEP_CELLS", 64), ("BUCKET_MEMBERS", 5)):
        monkeypatch.setattr(ngramjoin, name, value)
    rows = near_copies(7, families=3, size=25)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngramjoin.jaccard_components(docs, 3, 80).collect()
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in got} == plain_components(rows, 3, 80)


def test_jaccard_pairs_that_cannot_link_are_not_tested(spark, monkeypatch):
    # each shares about 6 of 10 n-grams with any other, and so whole segments, but none links
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(1500)]
    rows = []
    for i in range(24):
        text = list(base)
        for at in rng.choice(1500, 42, replace=False):
            text[at] = f"x{rng.integers(1 << 40)}"
        rows.append((i, " ".join(text)))
    rows.append((24, rows[5][1] + " end"))
    tested, write = [], ngramjoin.materialize

    def written(df, name):
        made = write(df, name)
        if name == "pairs":
            tested.append(made.count())
        return made

    monkeypatch.setattr(ngramjoin, "materialize", written)
    got = ngramjoin.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()
    assert {r["id"]: r["component"] for r in got} == {i: 5 if i == 24 else i for i in range(25)}
    assert 1 <= sum(tested) <= 3


@pytest.mark.parametrize("percent", [60, 80, 90, 100])
def test_sketches_rule_out_no_link(percent):
    rng = np.random.default_rng(percent)
    ruled_out = 0
    for n in (1, 7, 250, 256, 257, 1000, 3000):
        base = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        sets = []
        for share in (1, 1, 0.97, 0.9, 0.85, 0.8, 0.6, 0.3):
            kept = base[rng.random(n) < share]
            sets.append(np.unique(np.append(kept, rng.integers(0, 1 << 64, int(rng.integers(0, n // 9 + 2)), np.uint64))))
        sets.append(np.arange(400, dtype=np.uint64))  # all in one range
        offsets = np.append(0, np.cumsum([len(x) for x in sets]))
        found = ngramjoin.sketches(ngramjoin.Sets(np.concatenate(sets), offsets)).to_pylist()
        able = ngramjoin.may_link(np.diff(offsets), found, percent)
        assert found[-1] == b"" and all(sum(f) == len(x) for f, x in zip(found[:-1], sets))
        for i, j in zip(*np.triu_indices(len(sets), 1)):
            both = len(np.intersect1d(sets[i], sets[j]))
            linked = 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)
            assert able[i, j] == able[j, i] and (able[i, j] or not linked)
            ruled_out += not able[i, j]
    assert ruled_out > 50


def test_blocks_of_short_sets_meet_in_little_memory():
    rng = np.random.default_rng(1)
    n = 2048
    grams = [np.sort(rng.choice(6000, 8, replace=False)) for _ in range(n)]
    grams[3] = grams[1500]
    table = pa.table({"grams": pa.array(grams, pa.list_(pa.int64())), "label": np.arange(n), "block": np.arange(n) // 1024})
    tracemalloc.start()
    found = ngramjoin._between(table, 80)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.to_pylist() == [{"a": 3, "b": 1500}]
    assert most < 64 << 20


def test_rounds_of_few_edges_write_few_files(spark, monkeypatch):
    files, write = [], graph.materialize

    def written(df, name):
        made = write(df, name)
        files.append(len(made.inputFiles()))
        return made

    monkeypatch.setattr(graph, "materialize", written)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("64", "false")):
            spark.conf.set(k, v)
        edges = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 30], "a long, b long")
        got = {r["id"]: r["component"] for r in components(edges).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: (i - 1) // 30 * 30 + 1 for i in range(1, 301)}
    assert len(files) > 2 and max(files[1:]) <= 8


def test_jaccard_odd_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (1, "a b c d"), (None, None), (2, "A B C D"), (3, "p q r"),
                                  (3, "a b c d"), (3, "p q r")], "doc_id long, text string")
    got = ngramjoin.jaccard_components(docs, 3, 90).collect()
    assert len(got) == 7
    assert {r["component"] for r in got if r["id"] is None} == {None}
    assert {r["component"] for r in got if r["id"] in (1, 2)} == {1}
    assert len({r["component"] for r in got if r["id"] == 3}) == 1
    assert ngramjoin.jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("words,percent", [(3, 90), (5, 80), (1, 60), (2, 100)])
def test_texts_are_hashed_in_groups(monkeypatch, words, percent):
    texts = [t for _, t in near_copies(words)] * 3
    alone = [ngramjoin.shingles(t, words) for t in texts]
    plain = plain_components(enumerate(texts), words, 100)
    assert [len(h) for h in alone] == [plain[i][0] for i in range(len(texts))]
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(ngramjoin, "GROUP_BYTES", size)
        place = 0
        for start, sets in ngramjoin._shingled(pa.array(texts), words):
            assert start == place
            sigs, owner = ngramjoin.signature_rows(sets, percent)
            fp1, spare = ngramjoin.fingerprints(sets)[0], ngramjoin.spare_rows(sets, percent)
            for i, hashes in enumerate(alone[start:start + len(sets.sizes)]):
                assert np.array_equal(hashes, sets.grams[sets.offsets[i]:sets.offsets[i + 1]])
                own = ngramjoin.signatures(hashes, percent)
                assert np.array_equal(np.sort(sigs[owner == i]), np.sort(own))
                assert dict(spare[i]) == ngramjoin.spares(hashes, percent)
                assert fp1[i] == ngramjoin.mix64(hashes).sum().view(np.int64)
            place += len(sets.sizes)
        assert place == len(texts)
    # one group: the work on its texts takes few calls, not some for each of them
    calls, mix = [], ngramjoin.mix64
    monkeypatch.setattr(ngramjoin, "mix64", lambda x: calls.append(len(x)) or mix(x))
    [(_, sets)] = ngramjoin._shingled(pa.array(texts), words)
    ngramjoin.fingerprints(sets)
    assert len(calls) == words + 2 and len(texts) > 300


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for _ in range(300):
        n = int(rng.integers(1, 200))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        drop = int(rng.integers(0, n // 5 + 2))
        b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 2)), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b))
        if len(b) and len(a) and 100 * both >= percent * (len(a) + len(b) - both) and not np.array_equal(a, b):
            # also when each leaves out what it can spare, by one order for both
            left = []
            for hashes in (a, b):
                sigs = np.sort(ngramjoin.signatures(hashes, percent))
                kinds = sigs & ((1 << ngramjoin.CLASS_BITS) - 1)
                left.append(np.concatenate([sigs[kinds == k][spare:] for k, spare in
                                            ngramjoin.spares(hashes, percent).items()]))
            assert np.intersect1d(*left).size


def plain_top(vectors, k, every):
    out = {}
    for q, x in vectors.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors.items() if i != q)[:k]
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return out


@pytest.mark.parametrize("scale,block_rows", [(1.0, None), (1.0, 40), (1e3, 64), (3e6, 100)])
def test_top_k(spark, scale, block_rows):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(300, 40)) * 20) / 256 * scale
    x[50:80] = x[50]  # ties
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    want = plain_top({i: [int(np.floor(256 * v)) for v in r] for i, r, _ in rows}, 5, 10)
    bad = [(1000, None, 0), (1010, [1.0, None], 0), (1020, [float("nan")] * 40, 0), (None, [1.0] * 40, 0),
           (1030, [float("inf")], 0)]
    df = spark.createDataFrame(rows + bad + rows[:20], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(topk.whole_vectors(df, "vec_id", "embedding", 256.0), F.col("id") % 10 == 0, 5, block_rows)
    found = collections.defaultdict(list)
    for r in sorted(got.collect()):
        found[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    assert found == want


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (7, [0.5, 2.0]), (10, [])], "id long, v array<double>")
    got = topk.top_k(topk.whole_vectors(df, "id", "v", 256.0), F.col("id") % 10 == 0, 5).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 7, 128 * 256), (0, 2, 10, 0), (10, 1, 0, 0), (10, 2, 7, 0)]
    assert topk.top_k(topk.whole_vectors(df.limit(0), "id", "v", 256.0), F.col("id") % 10 == 0, 5).count() == 0


def test_components_are_floored(spark):
    values = [-1e-20, -0.0, 0.0, 1e-20, -1.0, -0.00390625, 0.999, 2.0 ** 60, -2.0 ** 60, 2.0 ** 45 + 0.5, -5e-324]
    df = spark.createDataFrame([(0, values)], "id long, v array<double>")
    got = topk.whole_vectors(df, "id", "v", 256.0).first()["vec"]
    assert got == [float(math.floor(256.0 * v)) for v in values]


def test_hosts(spark):
    urls = {"http://A.example.com/x": "a.example.com", "https://u:p@b.org:81/": "b.org", "ftp://c.net.?q": "c.net",
            "no url": None, "": None, None: None, "http:///x": None, "http://d.com#top": "d.com"}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r["url"]: r["h"] for r in df.select("url", urlfilter.host_of(F.col("url")).alias("h")).collect()} == urls
    got = df.sparkSession.createDataFrame([("a.b.c.org",), ("org",)], "h string").select(
        urlfilter.domains_of(F.col("h"))).collect()
    assert [r[0] for r in got] == [["a.b.c.org", "b.c.org", "c.org"], ["org"]]


def test_url_filters_at_fetch_time(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "PERIOD", 50)
    rng = np.random.default_rng(3)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "c.b.org"]
    captures = [(i, f"http://{hosts[int(rng.integers(5)) if i % 3 else 0]}/p", int(rng.integers(0, 300))) for i in range(120)]
    captures += [(200, None, 5), (201, "http://a.com/", None), (202, "bad", 7), (0, captures[0][1], captures[0][2])]
    entries = [("l" + str(rng.integers(2)), str(rng.choice(["host", "domain"])), str(rng.choice(hosts)).upper(),
                str(rng.choice(["add", "remove"])), int(rng.integers(0, 300))) for _ in range(40)]
    odd = [("l0", "host", None, "add", 1), ("l0", "host", "a.com", "add", None), ("l0", "what", "a.com", "add", 1),
           ("l0", "host", "a.com", "oops", 1)]

    def active(host, at):
        state = {}
        for name, kind, pattern, action, t in sorted(entries, key=lambda e: (e[4], e[3] == "remove")):
            if t <= at:
                state[name, kind, pattern.lower()] = action == "add"
        return sorted(k for k, on in state.items() if on and (host == k[2] or k[1] == "domain" and host.endswith("." + k[2])))

    seen = spark.createDataFrame(captures, "page_id long, url string, fetched_at long").withColumn("list", F.lit(1))
    listed = spark.createDataFrame(entries + odd, "list string, kind string, pattern string, action string, at long")
    got = urlfilter.filter_urls(seen, listed).collect()
    assert len(got) == len(captures)
    for r in got:
        host = r["url"][7:-2] if r["page_id"] < 200 else None
        want = active(host, r["fetched_at"]) if host else []
        assert [(m["list"], m["kind"], m["pattern"]) for m in r["matches"]] == want
    assert all(r["matches"] == [] for r in urlfilter.filter_urls(seen, listed.limit(0)).collect())
    assert urlfilter.filter_urls(seen.limit(0), listed).count() == 0


def test_url_filters_of_top_level_domains(spark):
    hosts = ["a.zip", "x.y.zip", "zip", "zip.com", "a.com", "ozip"]
    seen = spark.createDataFrame([(i, f"http://{h}/", 5) for i, h in enumerate(hosts)], "page_id long, url string, fetched_at long")
    listed = spark.createDataFrame([("l", "domain", "zip", "add", 1), ("l", "host", "com", "add", 1)],
                                   "list string, kind string, pattern string, action string, at long")
    got = urlfilter.filter_urls(seen, listed).where(F.size("matches") > 0)
    assert sorted(r["page_id"] for r in got.collect()) == [0, 1, 2]


def test_merkle_audit(spark):
    rows = [(a, s, bytes(f"record {a} {s} ", "ascii") * (s % 5 + 1)) for a in ("x", "y", "z") for s in range(300)]
    other = [r for r in rows if r[:2] not in (("x", 17), ("z", 299))]
    other = [(a, s, b[:-1] + b"!") if (a, s) == ("y", 100) else (a, s, b[:3]) if (a, s) == ("y", 255) else (a, s, b)
             for a, s, b in other] + [("y", 300, b"more"), ("w", 0, b"new")]
    schema = "archive string, seq long, record binary"
    ours, theirs = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    got = {(r["archive"], r["seq"]): r for r in warc.audit(ours, theirs, fan=4).collect()}
    assert {k: r["problem"] for k, r in got.items()} == {
        ("x", 17): "missing", ("z", 299): "missing", ("y", 100): "changed", ("y", 255): "resized",
        ("y", 300): "extra", ("w", 0): "extra"}
    assert got["y", 100]["record_offset"] == sum(len(b) for a, s, b in rows if a == "y" and s < 100)
    assert warc.audit(ours, ours.union(ours).withColumn("page_id", F.lit(1))).count() == 0
    assert warc.audit(ours, theirs.limit(0)).count() == len(rows)
    assert warc.audit(ours.limit(0), ours.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, 1, b"a"), ("x", None, b"a"), ("x", 1, None)], schema)
    assert warc.audit(odd, ours.limit(0)).count() == 0


def test_merkle_audit_of_offsets(spark):
    """Wrong index entries are found, also behind lost and resized records; what those move is in place."""
    schema = "archive string, seq long, record binary"
    rows = [("x", s, bytes([s]) * (s % 7 + 1)) for s in range(90)]
    other = [(a, s, b + b"+" if s == 20 else b) for a, s, b in rows if s != 5]
    starts, at = {}, 0
    for _, s, b in other:
        starts[s], at = at, at + len(b)
    index = [("x", s, o + {0: 3, 44: -2, 89: 7}.get(s, 0)) for s, o in starts.items() if s != 60] + [("x", 44, starts[44] + 9), ("q", 1, 4)]
    ours, theirs = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema)
    found = warc.audit(ours, theirs, 4, replica_index=spark.createDataFrame(index, "archive string, seq long, record_offset long"))
    assert {r["seq"]: r["problem"] for r in found.collect()} == {
        5: "missing", 20: "resized", 0: "misplaced", 44: "misplaced", 89: "misplaced"}
    whole = spark.createDataFrame([("x", s, sum(len(b) for _, t, b in rows if t < s)) for s in range(90)], "archive string, seq long, record_offset long")
    assert warc.audit(ours, ours, 4, whole).count() == 0


def test_merkle_nodes_hash_their_children(spark):
    rows = [("x", s, bytes([s])) for s in range(5)]
    leaf = warc.leaves(spark.createDataFrame(rows, "archive string, seq long, record binary"))
    levels = warc.merkle_levels(leaf, 2, fan=4)
    digests = [hashlib.sha256(f"{hashlib.sha256(bytes([s])).hexdigest()}:1:0".encode()).hexdigest() for s in range(5)]
    parts = [hashlib.sha256("|".join(f"{s}:{digests[s]}" for s in r).encode()).hexdigest() for r in (range(4), range(4, 5))]
    assert [(r["node"], r["start"], r["stop"], r["digest"]) for r in levels[1].orderBy("node").collect()] == [
        (0, 0, 4, parts[0]), (1, 4, 5, parts[1])]
    root = hashlib.sha256(f"0:{parts[0]}|1:{parts[1]}".encode()).hexdigest()
    assert [(r["start"], r["stop"], r["digest"]) for r in levels[2].collect()] == [(0, 5, root)]


def test_warc_record(spark):
    got = spark.createDataFrame([("http://a", "é"), (None, None)], "u string, h string").select(
        warc.warc_record(F.col("u"), F.col("h")).alias("r")).collect()
    assert bytes(got[0]["r"]).endswith("Content-Length: 2\r\n\r\né\r\n\r\n".encode())
    assert b"Content-Length: 0\r\n" in bytes(got[1]["r"])


def test_url_filters_keep_any_columns(spark):
    pages = spark.createDataFrame([("http://a.b.com/x", 10, 1, "h", 2, 3, 4, 5)],
                                  "url string, fetched_at long, _host int, matches string, _at int, _period int, _h int, _entries int")
    entries = spark.createDataFrame([("l", "domain", "b.com", "add", 5)], "list string, kind string, pattern string, action string, at long")
    got = urlfilter.filter_urls(pages, entries)
    assert got.columns == [*pages.columns, "_matches"] and tuple(got.first())[:8] == tuple(pages.first())
    assert len(got.first()["_matches"]) == 1
