"""Suffix-array dedup against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stanzaflow.llm import suffix


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60), st.booleans())
def test_suffix_array(symbols, wide):
    t = np.array([*[x * (5000 if wide else 1) for x in symbols], 0], np.int64)
    want = sorted(range(len(t)), key=lambda i: t[i:].tolist())
    assert suffix.suffix_array(t).tolist() == want


def test_suffix_array_recursion(monkeypatch):
    rng = np.random.default_rng(1)
    for text in (rng.integers(1, 3, 3000), np.tile([1, 2, 1, 3], 500), rng.integers(1, 250, 20000), np.repeat([3, 1, 2], 400)):
        t = np.append(text, 0)
        raw = (t + 1).astype(">u2").tobytes()
        want = sorted(range(len(t)), key=lambda i: raw[2 * i : 2 * i + 9000])
        assert suffix.suffix_array(t).tolist() == want
        for kind in (suffix._Waves, suffix._Single):
            monkeypatch.setattr(suffix, "_BUCKET", 1 << 30 if kind is suffix._Single else 0)
            assert suffix.suffix_array(t).tolist() == want


def test_common_prefixes():
    t = np.array([5, 1, 5, 1, 5, 1, 9, 5, 1, 5, 0])
    sa = suffix.suffix_array(t)
    got = suffix.common_prefixes(t, sa, 3)
    for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
        n = 0
        while n < 3 and max(a, b) + n < len(t) and t[a + n] == t[b + n]:
            n += 1
        assert got[b] == n


def brute(rows):
    """rows: (doc_id, text)."""
    first = {}
    for doc, text in rows:
        raw = (text or "").encode()
        if doc is not None:
            for i in range(len(raw) - 49):
                w = raw[i : i + 50]
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if doc is not None and first[raw[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(frame):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=str)


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 8)).astype(np.uint8)).decode() for _ in range(300)]
    say = lambda k: " ".join(rng.choice(words, k))
    passages = [say(int(k)) for k in (9, 12, 20, 60)] + ["é" * 40, "ab" * 45, "x" * 130]
    rows = []
    for i in range(n):
        parts = [say(int(rng.integers(0, 30)))]
        for _ in range(rng.integers(0, 3)):
            parts += [passages[rng.integers(len(passages))], say(int(rng.integers(0, 12)))]
        rows.append((int(i * 7 % n), " ".join(parts)))
    return rows


@pytest.mark.parametrize(("split", "flush"), [(4096, 1 << 19), (0, 1 << 19), (3, 40), (1, 400)])
def test_against_brute_force(spark, monkeypatch, split, flush):
    """Anchors kept together or split into windows, in all or some tasks; many small tasks' lists."""
    monkeypatch.setattr(suffix, "SPLIT", split)
    monkeypatch.setattr(suffix, "_FLUSH", flush)
    rows = corpus(3) + [(500, None), (501, ""), (502, "x" * 49), (503, "x" * 50), (504, "x" * 50), (None, "x" * 70)]
    rows += [rows[0], (rows[1][0], "other " + rows[2][1]), (600, rows[5][1]), (601, rows[5][1])]
    docs = spark.createDataFrame([(d, t, "a") for d, t in rows], "doc_id long, text string, spans string")
    assert rows_of(suffix.dedup(docs)) == brute(rows)


def test_small_shards_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD", 500)
    monkeypatch.setattr(suffix, "ARRAY", 300)
    rows = corpus(4, 60)
    rows += [(1000, " ".join(t for _, t in rows)), (1001, "ab" * 3000), (1002, "b" + "ab" * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(suffix.dedup(docs)) == brute(rows)


def test_segments_of_a_long_text():
    text = bytes(np.random.default_rng(5).integers(97, 123, 3 * suffix._STEP + 77).astype(np.uint8))
    seen = np.zeros(len(text) - 49, int)
    for data, ends, owner, offset in suffix._blocks([text, b"short"]):
        start, count, *_ = suffix.pieces(data, ends)
        at = start - np.concatenate(([0], ends))[np.searchsorted(ends, start, "right")] + offset[np.searchsorted(ends, start, "right")]
        for a, n in zip(at.tolist(), count.tolist(), strict=True):
            seen[a : a + n] += 1
    assert (seen == 1).all()


def test_empty_table(spark):
    assert suffix.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_line_between_different_neighbours(spark, monkeypatch):
    """One line in all documents, each time between other words: its anchor is split, and no text is lost."""
    monkeypatch.setattr(suffix, "SPLIT", 50)
    rng = np.random.default_rng(8)
    noise = lambda: "".join(rng.choice(list("abcdefghij"), 30))
    rows = [(i, f"{noise()} click here to read the whole story{'!' * (i % 3)} {noise()}") for i in range(200)]
    rows += [(300 + i, rows[i][1][10:90]) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = rows_of(suffix.dedup(docs))
    assert got == brute(rows) and sum(r[2] > 0 for r in got) >= 20
