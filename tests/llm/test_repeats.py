"""Removal of repeated substrings, against a plain version."""

import collections
import hashlib

import numpy as np
import pytest

from tessella.llm import repeats


def plain(texts, length):
    """Per text: bytes, bytes removed, spans, digest of the rest."""
    where = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for d in data:
        where.update(d[i:i + length] for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - length + 1):
            if where[d[i:i + length]] > 1:
                gone[1 + i:1 + i + length] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        rest = bytes(b for b, g in zip(d, gone[1:]) if not g)
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return out


def texts_with_passages(seed, n=60):
    """Texts of random words: shared passages of many lengths, near copies, copies, runs of one character."""
    rng = np.random.default_rng(seed)

    def words(k):
        return " ".join("".join(rng.choice(list("abcdeé"), 4)) for _ in range(k))

    passages = [words(int(k)) for k in rng.integers(15, 90, 6)]
    out = []
    for _ in range(n):
        text = words(int(rng.integers(1, 200)))
        for p in rng.choice(len(passages), 2):
            if rng.random() < 0.5:
                cut = int(rng.integers(0, len(text) + 1))
                text = text[:cut] + passages[p][int(rng.integers(0, 30)):] + text[cut:]
        out.append(text)
    for text in out[:12]:  # near copies
        at = int(rng.integers(0, len(text) + 1))
        out.append(text[:at] + "#" + text[at + 1:])
    out += [out[3], out[3], out[7], "", None, "x" * 199, "y" * 200, "z" * 201, "ab" * 150, "ab" * 90 + "c", " " * 700]
    return out


@pytest.mark.parametrize("seed,length,group_contexts", [(0, 200, 512), (1, 200, 2), (2, 120, 4), (3, 100, 512)])
def test_remove_repeats(spark, monkeypatch, seed, length, group_contexts):
    texts = texts_with_passages(seed)
    rows = [(i if i % 7 else None, t, "x", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string, c1 int").repartition(5)
    got = sorted(map(str, (tuple(r) for r in repeats.remove_repeats(docs, length=length, group_contexts=group_contexts).collect())))
    want = plain(texts, length)
    assert got == sorted(str((r[0], *w)) for r, w in zip(rows, want))
    assert any(w[1] for w in want)


def test_no_rows_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a" * 250, 1, 2)], "`doc id` long, c1 string, text int, rows int")
    assert repeats.remove_repeats(docs.limit(0), "doc id", "c1").count() == 0
    assert tuple(repeats.remove_repeats(docs, "doc id", "c1").first())[:4] == (1, 250, 250, 1)


def test_windows_cut_into_chunks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    text = "".join(rng.choice(list("abcd"), 9000))
    texts = [text + text[100:4000] + "q", text[2000:2600]]
    parts = repeats._runs([(texts[0].encode(), 0, 1, 2)], 200)
    monkeypatch.setattr(repeats, "CHUNK_BITS", 11)
    whole = collections.Counter(zip(parts["anchor"].tolist(), parts["at"].tolist()))
    cut = [repeats._runs([(texts[0].encode()[a:a + 1500 + 199], a, 1, 2)], 200) for a in range(0, len(texts[0]) - 199, 1500)]
    assert set(whole) == {k for c in cut for k in zip(c["anchor"].tolist(), c["at"].tolist())}
    assert sum((c["hi"] - c["lo"] + 1).sum() for c in cut) == len(texts[0]) - 199


@pytest.mark.parametrize("weak", [0, 1, 255])
def test_collisions_are_found(monkeypatch, weak):
    """With hashes that hardly tell bytes apart the result is the same."""
    rng = np.random.default_rng(weak)
    text = bytes(rng.choice(list(b"abc"), 600).astype(np.uint8))
    pool = np.frombuffer(text + text[50:400] + bytes(rng.choice(list(b"abc"), 300).astype(np.uint8)) + bytes(8), np.uint8)
    at = rng.permutation(len(pool) - 8 - 120)[:700]
    group = at % 5
    monkeypatch.setattr(repeats, "_byte_values", lambda: (np.arange(256) & weak).astype(np.uint64))
    windows = collections.Counter((g, pool[a:a + 120].tobytes()) for a, g in zip(at.tolist(), group.tolist()))
    got = repeats.repeated_starts(pool, at, group, 120)
    assert got.tolist() == [windows[g, pool[a:a + 120].tobytes()] > 1 for a, g in zip(at.tolist(), group.tolist())]


def test_merge_sort_sorts_suffixes():
    rng = np.random.default_rng(0)
    data = np.frombuffer(bytes(rng.choice(list(b"ab"), 4000).astype(np.uint8)) + bytes(8), np.uint8)
    at = rng.permutation(3700)[:1000]
    size = np.array([1, 2, 3, 64, 130, 800])
    first = np.cumsum(size) - size
    got = repeats._merge_sort(data, repeats.Hashes(data), at, first, size, 200)
    for a, n in zip(first, size):
        assert got[a:a + n].tolist() == sorted(at[a:a + n].tolist(), key=lambda p: data[p:p + 200].tobytes())
