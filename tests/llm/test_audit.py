"""The audit against counts of every order, and the galloping merges."""

import random
from itertools import permutations

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import oracle_check
from aisle.llm import audit, queries

SORTED = st.lists(st.integers(0, 5000), max_size=400, unique=True).map(lambda x: np.array(sorted(x), np.int32))


@settings(max_examples=60, deadline=None)
@given(SORTED, SORTED, SORTED)
def test_merges_of_lists(a, b, c):
    a, b, c = a.astype(np.int32), b.astype(np.int32), c.astype(np.int32)
    assert audit.difference(a, b, c).tolist() == sorted(set(a) - set(b) - set(c))
    assert audit.union(a, b, c).tolist() == sorted({*a, *b, *c})
    assert audit.shared(a, b).tolist() == [x in set(b.tolist()) for x in a.tolist()]


def test_long_lists_of_blocks():
    rnd = np.random.default_rng(3)
    a = np.unique(rnd.integers(0, 1 << 20, 9000)).astype(np.int32)
    b = np.unique(rnd.integers(0, 1 << 20, 200_000)).astype(np.int32)
    assert audit.difference(a, b).tolist() == np.setdiff1d(a, b).tolist()
    assert audit.union(a, b).tolist() == np.union1d(a, b).tolist()
    assert audit.difference(b, a).tolist() == np.setdiff1d(b, a).tolist()


ROWS = "doc_id long, part string, A boolean, B boolean, C boolean, good boolean, ids string, flags string, n_rows int"


def brute(rows):
    out = {}
    for part in {r[1] or "" for r in rows}:
        own = [r for r in rows if (r[1] or "") == part]
        shapley = dict.fromkeys("ABC", 0)
        for order in permutations("ABC"):
            left = own
            for step, f in enumerate(order, 1):
                i = "ABC".index(f) + 2
                gone = [r for r in left if r[i]]
                left = [r for r in left if not r[i]]
                fails = [r for r in own if r[i]]
                only = [r for r in fails if sum(map(bool, r[2:5])) == 1]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(fails) - len(gone), len(only), sum(bool(r[5]) for r in gone), f]
        for (p, o, s), v in out.items():
            if p == part:
                v[-1] = shapley[v[-1]]
    return out


def test_against_every_order(spark, monkeypatch):
    monkeypatch.setattr(audit, "SEGMENT", 7)
    rnd = random.Random(2)
    flag = lambda: rnd.choice([True, False, None])
    rows = [(rnd.choice([None, *range(40)]), rnd.choice([None, "", "a", "a", "b"]), flag(), flag(), flag(), flag(), "x", "y", 1) for _ in range(150)]
    rows += rows[:20]  # rows that repeat
    df = spark.createDataFrame(rows, ROWS)
    got = audit.interactions(df, "doc_id", "part", {f: f for f in "ABC"}, {"good": "good"}).collect()
    assert {(r["part"], r["filter_order"], r["step"]): [r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["lost_good"], r["shapley"]]
            for r in got} == brute(rows)
    assert len(got) == 3 * 6 * 3  # a null part is the empty one
    lists = audit.posting_lists(df, "doc_id", "part", {"A": "A"}, {}).collect()
    assert sum(r["n_rows"] for r in lists) == len(rows) and max(r["n_rows"] for r in lists) == 7
    assert all(r["A"] == sorted(r["A"]) and len(r["ids"]) == r["n_rows"] for r in lists)
    assert audit.interactions(df.limit(0), "doc_id", "part", {f: f for f in "ABC"}, {"good": "good"}).collect() == []


def test_copies(spark):
    df = spark.createDataFrame([(1, b"x"), (1, b"x"), (2, b"x"), (None, b"x"), (2, b"y"), (3, None), (4, None)], "doc_id long, digest binary")
    got = audit.first_of_text(df, "doc_id", "digest").collect()
    # the least id's rows are no copies; without a digest nothing is equal
    assert sorted((r["doc_id"] or 0, bytes(r["digest"] or b""), r["later"]) for r in got) == [
        (0, b"x", False), (1, b"x", False), (1, b"x", False), (2, b"x", True), (2, b"y", False), (3, b"", True), (4, b"", True)]


def test_query(spark, sf_dir):
    con = oracle_check.duck_connect(sf_dir)

    class Entry:
        fn = staticmethod(queries.op11_audit)
    r = oracle_check.compare(spark, con, "op11_audit", Entry, queries.ORACLE_SQL["op11_audit"], sf_dir)
    assert r["ok"], r


def test_odd_documents(spark, tmpdir_path):
    docs = [(1, None, None), (2, "", ""), (3, "  ", "s"), (4, "a " * 60, "s"), (5, "a " * 60, "s"), (6, "A$" * 100_000, "s"),
            (7, " ".join(map(str, range(80))), "s"), (7, "x\x0by\x0cz", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmpdir_path}/documents.parquet")
    spark.createDataFrame([(7, 1, 0), (7, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmpdir_path}/{t}.parquet/*.parquet')")

    class Entry:
        fn = staticmethod(queries.op11_audit)
    r = oracle_check.compare(spark, con, "op11_audit", Entry, queries.ORACLE_SQL["op11_audit"], tmpdir_path)
    assert r["ok"], r
