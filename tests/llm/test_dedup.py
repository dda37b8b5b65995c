"""SimHash and exact dedup against brute force."""

import itertools

import numpy as np
import pytest
import xxhash

from stanzaflow.llm import components, exact, simhash


def brute_fingerprint(text):
    words, word = [], b""
    for b in (text or "").encode() + b" ":
        if b == 0x20 or 9 <= b <= 13:
            words += [word] if word else []
            word = b""
        else:
            word += bytes([b + 32 if 65 <= b <= 90 else b])
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


TEXTS = ["", None, " \x0b\x0c ", "One", "one two", "One TWO three", "a b c d", "a  b\tc\nd e e e e e", "É é\x1c x y z", "x " * 500]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("block", [1, 7, 40])
def test_fingerprint_by_blocks(monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(4)
    for text in [*TEXTS, *(" ".join(rng.choice(["a", "bcd", "Éf", " \t", "ghijkl"], int(n))) for n in rng.integers(0, 60, 40))]:
        assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_very_long_text_in_bounded_memory():
    import tracemalloc

    text = b"plain words, here and there. " * 700_000  # 20 MB
    tracemalloc.start()
    fp = simhash.fingerprint(text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert fp == simhash.fingerprint(b"plain words, here and there. " * 70) and peak < 60e6


def brute_components(fps):
    """fps: {doc: fingerprint}."""
    group = {d: {d} for d in fps}
    for a, b in itertools.combinations(fps, 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2 and group[a] is not group[b]:
            joined = group[a] | group[b]
            for d in joined:
                group[d] = joined
    return {d: min(g) for d, g in group.items()}


def planted(seed=2):
    rng = np.random.default_rng(seed)
    fps, doc = {}, 0
    for _ in range(40):
        base = int(rng.integers(0, 1 << 63)) << 1
        for _ in range(int(rng.integers(1, 8))):
            fps[doc] = base
            doc += 1
            for bit in rng.integers(0, 64, int(rng.integers(0, 4))):
                base ^= 1 << int(bit)
    return fps


@pytest.mark.parametrize("bucket", [64, 1])
def test_components(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    fps = planted()
    signed = [(d, int(np.uint64(f).astype(np.int64))) for d, f in fps.items()]
    rows = spark.createDataFrame(signed, "doc_id long, fp long")
    label = {r["fp"]: r["component_id"] for r in simhash.components(rows).collect()}
    assert {d: label[f] for d, f in signed} == brute_components(fps)


def test_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500)], "a long, b long")
    got = {r["node"]: r["label"] for r in components.connected_components(links).collect()}
    assert got == dict.fromkeys(range(201), 0)


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs.collect()}
    want = brute_components(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_groups(docs).collect()}
    assert got == {d: (f"{f:016x}", want[d]) for d, f in fps.items()}
    kept = sorted(r["doc_id"] for r in simhash.near_dedup(docs).collect())
    assert kept == sorted(set(want.values()))


def test_exact_salts_and_repeats(spark):
    rows = [(i, None if i % 5 == 0 else "hot" if i % 3 else f"t{i % 7}", i * 10) for i in range(300)] + [(1, "hot", 10), (None, "hot", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id long").repartition(16)
    best, size = {}, {}
    for d, t, _ in rows:
        size[t or ""] = size.get(t or "", 0) + 1
        best[t or ""] = max(best.get(t or "", -1), -1 if d is None else d)
    got = exact.exact_groups(docs, salts=4).collect()
    assert len(got) == len(rows)
    texts = {(d): (t or "") for d, t, _ in rows}
    for r in got:
        if r["doc_id"] is not None:
            t = texts[r["doc_id"]]
            assert (r["keep_id"], r["group_size"], r["kept"]) == (best[t], size[t], r["doc_id"] == best[t])
    kept = exact.exact_dedup(docs, salts=4).collect()
    assert sorted((r["doc_id"], r["text"] or "", r["keep_id"]) for r in kept) == sorted((b, t, b * 10) for t, b in best.items())


def test_exact_with_columns_that_have_no_order(spark):
    docs = spark.createDataFrame([(1, "a", {"x": 1}, [{"y": 2}]), (3, "a", {"x": 2}, None), (3, "a", {"x": 3}, None), (2, None, None, None)], "doc_id long, text string, m map<string,int>, l array<map<string,int>>")
    got = sorted((r["doc_id"], r["text"], r["m"]) for r in exact.exact_dedup(docs).collect())
    assert got == [(2, None, None), (3, "a", {"x": 3})]


def test_component_of_many_fingerprints(spark):
    """A hub of 10^5 nodes, and a chain."""
    n, m = 100_000, 100
    hub = spark.range(1, n).selectExpr("0L as a", "id as b")
    chain = spark.range(n, n + m - 1).selectExpr("id as a", "id + 1 as b")
    got = components.connected_components(hub.union(chain)).groupBy("label").count().collect()
    assert sorted(map(tuple, got)) == [(0, n), (n, m)]


def test_crowded_keys_link_through_neighbours(spark, monkeypatch):
    """Many fingerprints under one key: all that brute force links are linked."""
    rng = np.random.default_rng(9)
    fps = {int(i): int(x) for i, x in enumerate({(0xABCD << 48) | (0x1234 << 32) | int(y) for y in rng.integers(0, 4096, 600)})}
    monkeypatch.setattr(simhash, "BUCKET", 8)
    signed = [(d, int(np.uint64(f).astype(np.int64))) for d, f in fps.items()]
    label = {r["fp"]: r["component_id"] for r in simhash.components(spark.createDataFrame(signed, "doc_id long, fp long")).collect()}
    assert {d: label[f] for d, f in signed} == brute_components(fps)
