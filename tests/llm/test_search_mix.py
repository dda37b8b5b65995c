"""Nearest neighbours and mixing against brute force; the pipeline stage by stage."""

import hashlib
import re

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from stanzaflow.llm import ann, langid, mixing, piece
from test_dedup import brute_components, brute_fingerprint


def brute_nearest(rows, k=20):
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], np.float64)
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (v * v[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if i != q][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def jittered(spark):
    """8000 rows in groups of four around the vectors of sf0.1."""
    rng = np.random.default_rng(5)
    base = np.array([r["embedding"] for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()])
    v = np.repeat(base, 4, axis=0)
    v = (v + rng.normal(0, 0.05, v.shape))[rng.permutation(len(v))]
    return spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")


@pytest.mark.parametrize(("table", "shard"), [("sf0.01", 16384), ("sf0.1", 16384), ("sf0.1", 300), ("jittered", 16384)])
def test_recall(spark, table, shard):
    vectors = jittered(spark) if table == "jittered" else spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    want = brute_nearest([(r["vec_id"], r["embedding"]) for r in vectors.collect()])
    got: dict = {}
    for r in ann.nearest(vectors, shard=shard).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    assert all(x == sorted(x, key=lambda y: (-y[1], y[0])) for x in got.values())
    right = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    print("recall", table, shard, right / (20 * len(want)))
    assert right / (20 * len(want)) >= 0.9
    exact = {q: dict(x) for q, x in want.items()}
    assert all(s == exact[q][i] for q, x in got.items() for i, s in x if i in exact[q])


def test_few_are_verified():
    """A query verifies a small part of its shard, near the bound that ends its rounds."""
    v = np.random.default_rng(1).standard_normal((5000, 32))
    index = ann.Index(np.arange(5000), v)
    sizes = [len(near) for _, near in index.candidates(v[:100], 20)]
    assert np.mean(sizes) < 0.08 * 5000 and max(sizes) < 0.2 * 5000 and min(sizes) >= 0.04 * 5000


def test_collisions_are_counted():
    rng = np.random.default_rng(2)
    bits = rng.integers(0, 2, (37, 3, 128)).astype(np.uint8)
    digits = ann._sums(np.packbits(bits, axis=2, bitorder="little").view(np.uint64))
    for least in (1, 17, 20, 37):
        got = np.unpackbits(ann._at_least(digits, least).view(np.uint8), axis=1, bitorder="little")
        assert (got == (bits.sum(axis=0) >= least)).all()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 2 * sizes[s]}
        if not full:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2.0 * sizes[s] for s in full)
        free -= full
    return target


@pytest.mark.parametrize("seed", range(3))
def test_mixing(spark, seed):
    rng = np.random.default_rng(seed)
    share = rng.dirichlet([0.5] * 5)
    rows = [(i, None if i % 50 == 7 else "w " * int(rng.integers(0, 30)), [None, "b", "a", "É", "c"][rng.choice(5, p=share)]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_plan(docs).collect()
    sizes: dict = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    source = {d: s for d, _, s in rows}
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6 * max(1, target[s]) and 0 <= r["taken"] <= 2 * r["size"]
    assert all(taken[s] == int(target[s] + 1e-9) for s in sizes)
    assert sorted(map(tuple, mixing.mix_plan(docs.repartition(7)).collect())) == sorted(map(tuple, got))
    mixed: dict = {}
    for r in mixing.mix_documents(docs).collect():
        mixed[r["doc_id"]] = mixed.get(r["doc_id"], 0) + len(words(r["text"]))
        whole = next(t for d, t, _ in rows if d == r["doc_id"])
        assert whole.startswith(r["text"])
    assert mixed == {r["doc_id"]: r["taken"] for r in got if r["taken"]}


def test_mixing_one_large_source(spark):
    """A source of 10^6 rows is spread over many sorted partitions, and its budget is met exactly."""
    n = 1_000_000
    docs = spark.range(n + 1000).selectExpr("id as doc_id", "concat('w', if(id % 2 = 0, ' w w', '')) as text", f"if(id < {n}, 'hot', 'z') as source")
    plan = mixing._sized(docs, mixing.SEED)
    assert plan.where("source = 'hot'").select("range").distinct().count() > 1
    got = mixing.mix_plan(docs).groupBy("source_size", "target").agg({"taken": "sum"}).collect()
    assert {r["source_size"]: r["sum(taken)"] for r in got} == {2 * n: int(next(r["target"] for r in got if r["source_size"] == 2 * n)), 2000: 4000}


def test_pipeline_by_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.collect()
    out = [corpus_pipeline.STAGES[0][1](spark, docs, sf_dir)]
    model = langid.fit(docs)
    known = [r for r in rows if not model.predict(r["text"])[2]]
    assert sorted(map(tuple, out[0].collect())) == sorted(map(tuple, known)) and len(known) > 0.9 * len(rows)
    best: dict = {}
    for r in known:
        if r["text"] not in best or best[r["text"]]["doc_id"] < r["doc_id"]:
            best[r["text"]] = r
    out.append(corpus_pipeline.STAGES[1][1](spark, out[0], sf_dir))
    assert sorted(map(tuple, out[1].collect())) == sorted(map(tuple, best.values()))
    fps = {r["doc_id"]: brute_fingerprint(r["text"]) for r in best.values()}
    first = set(brute_components(fps).values())
    out.append(corpus_pipeline.STAGES[2][1](spark, out[1], sf_dir))
    kept = out[2].collect()
    assert sorted(map(tuple, kept)) == sorted(tuple(r) for r in best.values() if r["doc_id"] in first)
    out.append(corpus_pipeline.STAGES[3][1](spark, out[2], sf_dir))
    plan = {r["doc_id"]: r["taken"] for r in mixing.mix_plan(out[2]).collect()}
    mixed = out[3].collect()
    total: dict = {}
    for r in mixed:
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + len(words(r["text"]))
    assert total == {d: n for d, n in plan.items() if n} and out[3].columns == docs.columns
    lib = sentencepiece.SentencePieceProcessor(model_file=piece.default_model())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = sorted((r["doc_id"], len(i := lib.encode(r["text"])), sha(",".join(map(str, i))), sha(lib.decode(i))) for r in mixed)
    done = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, done.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())) == want
