"""Orchard's search against every centroid; the rounds against DuckDB."""

import hashlib

import numpy as np
import pytest

import oracle_check
from aisle.llm import centroids, queries


def nearest(vectors, centres):
    d = ((vectors[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)  # of equal ones the first


@pytest.mark.parametrize("spread", [2, 4, 50, 1 << 27])
def test_search(spread):
    rnd = np.random.default_rng(spread)
    for k in (1, 2, 3, 17, 40):
        centres = rnd.integers(-spread, spread + 1, (k, 5))  # few values: many ties and equal centroids
        vectors = np.concatenate([rnd.integers(-spread, spread + 1, (300, 5)), centres])
        got = centroids.Orchard(centres).nearest(vectors)
        want = nearest(vectors, centres)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_search_skips_far_centroids():
    rnd = np.random.default_rng(1)
    centres = rnd.integers(-100_000, 100_000, (200, 3))
    search = centroids.Orchard(centres)
    vectors = centres[rnd.integers(0, 200, 2000)] + rnd.integers(-50, 50, (2000, 3))
    assert search.nearest(vectors)[0].tolist() == nearest(vectors, centres)[0].tolist()
    assert search.compared < 2000 * 200 / 3


def lloyd(vectors, first, rounds):
    c = first.copy()
    for _ in range(rounds):
        own, _ = nearest(vectors, c)
        for i in set(own.tolist()):
            m = vectors[own == i]
            c[i] = [int(s) // len(m) for s in m.sum(axis=0)]
    return (c, *nearest(vectors, c))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.1, -0.2]), (2, [0.1, -0.2]), (2, [5.0, 5.0]), (None, [1.0, 1.0]), (3, None), (4, []), (5, [1.0]), (6, [1.0, None]),
            (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1e30, 0.0]), (10, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, e array<double>, cluster int, v int")
    got = centroids.cluster(df, "vec_id", "e", k=2, rounds=3, dimensions=2).collect()
    assert sorted((r["vec_id"] or 0) for r in got) == [0, 1, 2, 2, 10]
    assert len({r["inertia"] for r in got}) == 1 and got[0]["inertia"] == sum(r["distance"] for r in got)
    few = centroids.cluster(df.where("vec_id = 1"), "vec_id", "e", k=5, rounds=2, dimensions=2).collect()
    assert [(r["cluster"], r["distance"], r["centroid"]) for r in few] == [(0, 0, [25, -52])]
    assert centroids.cluster(df.limit(0), "vec_id", "e", k=2, rounds=1, dimensions=2).collect() == []


def test_query(spark, sf_dir):
    con = oracle_check.duck_connect(sf_dir)

    class Entry:
        fn = staticmethod(queries.op13_centroids)
    r = oracle_check.compare(spark, con, "op13_centroids", Entry, queries.ORACLE_SQL["op13_centroids"], sf_dir)
    assert r["ok"], r


def test_rounds(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    vectors = np.floor(256 * np.array([r["embedding"] for r in rows], np.float64)).astype(np.int64)
    order = sorted(range(len(rows)), key=lambda i: hashlib.sha256(f"2:{rows[i]['vec_id']}".encode()).hexdigest())[:40]
    centre, own, distance = lloyd(vectors, vectors[order], 5)
    got = {r["vec_id"]: r for r in centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding", 40, 5, 64).collect()}
    for i, r in enumerate(rows):
        g = got[r["vec_id"]]
        assert (g["cluster"], g["distance"], g["centroid"]) == (own[i], distance[i], centre[own[i]].tolist())
