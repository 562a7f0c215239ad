"""Similarity joins and components against brute force."""

import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from aisle.llm import ngram_join, queries, vector_join
from aisle.llm.components import components
from aisle.llm.shingles import shingles


def reach(nodes, edges):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(least[a], least[b])
            for x in (a, b):
                if least[x] != low:
                    least[x], changed = low, True
    return least


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(5, 3)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 40)],
    [(random.Random(4).randrange(9) * 7 + i % 5, i * 3 % 60) for i in range(60)], [(1, 2), (2, 1), (3, 3), (None, 1)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = reach({n for e in real for n in e}, real)
    assert got == want


def document_truth(rows, threshold=0.8):
    sets = {i: frozenset(shingles(t).tolist()) for i, t in rows}
    having = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    near = defaultdict(int)
    for ids in having.values():
        if len(ids) < 200:
            for k, a in enumerate(ids):
                for b in ids[k + 1:]:
                    near[a, b] += 1
    edges = [(a, b) for (a, b), n in near.items() if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold]
    empty = [i for i, s in sets.items() if not s]
    edges += [(a, b) for k, a in enumerate(empty) for b in empty[k + 1:]]
    links = defaultdict(int)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    return {i: (c, links[i]) for i, c in reach(sets, edges).items()}


def test_documents_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in queries.op6_ngram_join(spark, sf_dir).collect()}
    assert got == document_truth(rows)


def test_large_groups_and_edge_cases(spark, monkeypatch):
    """Buckets are split, blocks are compared pairwise, empty texts, nulls,
    short texts, repeats and clashing columns."""
    for name, small in (("LEAF", 8), ("BLOCK", 16), ("CLUSTER_BLOCK", 2000)):
        monkeypatch.setattr(ngram_join, name, small)
    rnd = random.Random(7)
    base = [[str(rnd.random()) for _ in range(40)] for _ in range(3)]
    passage = " ".join(str(rnd.random()) for _ in range(15))
    rows = []
    for i in range(150):
        words = list(base[i % 3])
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(40)] = str(rnd.random())
        rows.append((1000 - i, " ".join(words)))
    rows += [(2000 + i, passage + " " + " ".join(str(rnd.random()) for _ in range(5 + i % 9))) for i in range(60)]
    rows += [(3000, None), (3001, ""), (3002, "\n "), (3003, "one"), (3004, "one"), (3005, "two words"), (3006, " one ")]
    df = spark.createDataFrame([(i, t, 1, 2, 3, "k") for i, t in rows + rows[:2]] + [(None, "lost", 1, 2, 3, "k")],
                               "doc_id long, text string, rep long, m long, n long, key string")
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.similarity_join(df).collect()}
    assert got == document_truth(rows)


def test_near_copies_of_short_texts_are_bounded(spark, monkeypatch):
    """A block of a cluster is bounded in sets, also where they are small."""
    monkeypatch.setattr(ngram_join, "CLUSTER_SETS", 16, raising=False)
    largest = []
    real = ngram_join.by_key

    def by_key(df, key):
        if "hashes" in df.columns:
            largest.append(max(r["count"] for r in df.groupBy(key).count().collect()))
        return real(df, key)
    monkeypatch.setattr(ngram_join, "by_key", by_key)
    rows = [(i, " ".join(f"w{k}" for k in range(20)) + f" page{i}") for i in range(160)]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in ngram_join.similarity_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: (0, 159) for i, _ in rows}
    assert largest[0] < 2 * 2 * 16  # two blocks, and as much again for the chance of the deal


def test_pairs_of_sets_are_judged_in_stripes():
    n = 5000
    sets = [shingles(" ".join(f"w{k}" for k in range(20)) + f" page{i}").tobytes() for i in range(n)]
    batch = pa.RecordBatch.from_pydict({"pair": [1] * n, "rep": list(range(n)), "mult": [1] * n, "side": pa.array([-1] * n, pa.int32()), "hashes": sets})
    tracemalloc.start()
    links = [r for out in ngram_join._verified(0.8)(iter([batch])) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["rep"], r["links"], r["root"]) for r in links] == [(i, n - 1, 0) for i in range(n)]
    assert peak < 300e6  # the counts are 100 MB, and twice that while a product is added


def test_no_documents(spark):
    assert ngram_join.similarity_join(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def vector_truth(rows, cosine=0.95):
    good = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    edges = []
    for n in {len(v) for v in good.values()}:
        ids = [i for i, v in good.items() if len(v) == n]
        x = np.array([good[i] for i in ids])
        x /= np.linalg.norm(x, axis=1)[:, None]
        a, b = np.nonzero(np.triu(x @ x.T >= cosine, 1))
        edges += [(ids[p], ids[q]) for p, q in zip(a, b)]
    links = defaultdict(int)
    for a, b in edges:
        links[a] += 1
        links[b] += 1
    return {i: (links[i], c, i == c) for i, c in reach([i for i, _ in rows], edges).items()}


def test_vectors_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.op7_vector_join(spark, sf_dir).collect()}
    assert got == vector_truth(rows)


@pytest.mark.parametrize("dim", [1, 3, 20])
def test_vectors_split_and_edge_cases(spark, monkeypatch, dim):
    monkeypatch.setattr(vector_join, "CELL", 60)
    monkeypatch.setattr(vector_join, "PART", 25)
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(6, dim))
    rows = []
    for i in range(400):
        x = centres[i % 6] * rng.uniform(0.1, 9) + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.4])
        rows.append((i, x.tolist()))
    rows += [(500, None), (501, []), (502, [0.0] * dim), (503, [float("nan")] * dim), (504, [None] * dim), (505, [float("inf")] * dim),
             (506, [1.0] * (dim + 1)), (507, [2.0] * (dim + 1)), (508, [1e200] * dim), (509, [1e-200] * dim)]
    df = spark.createDataFrame([(i, v, "c", 1) for i, v in rows + rows[:3]] + [(None, [1.0] * dim, "", 0)],
                               "vec_id long, embedding array<double>, cell string, rep int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["vec_id"] == r["component_id"]) for r in vector_join.cosine_join(df).collect()}
    safe = [(i, (np.array(v) / np.abs(v).max()).tolist() if v and None not in v and np.isfinite(v).all() and np.any(v) else v) for i, v in rows]
    assert got == vector_truth(safe)


def test_near_copies_of_vectors_are_bounded(spark, monkeypatch):
    """A task reads blocks of a cell and not all of it, the tree follows the
    count, and links are added up instead of kept."""
    for name, small in (("CELL", 60), ("PART", 25), ("SAMPLE", 64)):
        monkeypatch.setattr(vector_join, name, small)
    spaces, largest = [], []
    real_space, real_by_key = vector_join.Space, vector_join.by_key
    monkeypatch.setattr(vector_join, "Space", lambda *args: spaces.append(real_space(*args)) or spaces[-1])

    def by_key(df, key):
        largest.append(max(r["count"] for r in df.groupBy(key).count().collect()))
        return real_by_key(df, key)
    monkeypatch.setattr(vector_join, "by_key", by_key)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=12)
    rows = [(i, (centre + rng.normal(size=12) * 0.01 if i % 3 else rng.normal(size=12)).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["vec_id"] == r["component_id"]) for r in vector_join.cosine_join(df).collect()}
    assert got == vector_truth(rows)
    assert spaces[0].depth == 3
    assert largest[0] < 2 * 3 * 25  # a block at home and one from elsewhere, and as much again for the chance of the deal


def test_links_of_vectors_are_not_kept():
    n = 5000
    x = np.random.default_rng(4).normal(size=8) + np.random.default_rng(5).normal(size=(n, 8)) * 1e-3
    space = vector_join.Space(8, "<f8", 0.95, n, [v.tobytes() for v in x])
    batch = pa.RecordBatch.from_pydict({
        "pair": [1] * n, "block": pa.array([0] * n, pa.int32()), "side": pa.array([-1] * n, pa.int32()), "home": [True] * n, "mine": [True] * n,
        "rep": list(range(n)), "mult": [1] * n, "vector": [v.tobytes() for v in x]})
    tracemalloc.start()
    links = [r for out in vector_join._compare(space)(iter([batch])) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["rep"], r["links"], r["root"]) for r in links] == [(i, n - 1, 0) for i in range(n)]
    assert peak < 150e6  # the pairs alone are 200 MB


def test_no_vectors(spark):
    assert vector_join.cosine_join(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
