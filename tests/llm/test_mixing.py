"""Mixing: targets by hand, words to the target, agreement with SQL."""

import duckdb
import pytest

from aisle.llm import mixing, queries

SCHEMA = "doc_id long, source string, size long, quality double, key string"


def by_source(rows):
    out = {}
    for r in rows:
        s = out.setdefault(r["source"], [0, r["target"], r["source_size"]])
        s[0] += r["taken"]
    return out


def test_targets_share_the_excess(spark):
    # 1.5 * 1000 words; b is full at 20, the other two share 1480 as 5 : 1
    rows = [(i, s, n, None, "x") for i, (s, n) in enumerate([("a", 790), ("b", 10), ("c", 200)])]
    got = by_source(mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got["b"] == [20, 20.0, 10]
    assert got["a"][1] == pytest.approx(1480 * 5 / 6) and got["c"][1] == pytest.approx(1480 / 6)
    assert all(abs(taken - target) <= 0.5 for taken, target, _ in got.values())


def test_nulls_ties_and_repeats(spark):
    rows = ([(i, None, 3, 2.0, "") for i in range(50)] + [(7, "s", 5, None, "")] * 20 + [(None, "s", 4, 0.0, "")] * 3
            + [(99, "empty", 0, 1.0, ""), (100, "é", 1000, 1.0, "")])
    result = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(result) == len(rows)
    got = by_source(result)
    assert got["empty"] == [0, 0.0, 0]
    assert all(abs(taken - target) <= 0.5 and target <= 2 * size for taken, target, size in got.values())
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in result)
    assert sum(t for _, t, _ in got.values()) == pytest.approx(1.5 * sum(r[2] for r in rows))


def test_better_documents_come_first(spark):
    rows = [(i, s, 10, 2.0 if i % 2 else 0.5, "") for i in range(2000) for s in ("a", "b", "c")]
    result = mixing.mix(spark.createDataFrame(rows, SCHEMA)).where("source = 'b'").collect()
    more = lambda odd: sum(r["taken"] - r["epochs"] * r["size"] for r in result if r["doc_id"] % 2 == odd)
    assert more(1) > 1.5 * more(0) > 0


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = con.sql("SELECT doc_id, size, source_size, target, taken FROM (" + queries.ORACLE_SQL["op3_mix"] + ")").fetchall()
    got = [tuple(r) for r in queries.op3_mix(spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)
