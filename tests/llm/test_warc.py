"""WARC archives: exact round trip, whatever the payloads hold."""

import base64
import hashlib
import tempfile

import duckdb
import pytest

from aisle.llm import queries, warc
from aisle.plans.runs import plan_nodes, run_in_place

INNER = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def round_trip(spark, rows, **options):
    df = spark.createDataFrame(rows, "page_id long, url string, html string, file string, digest string")
    path = tempfile.mkdtemp() + "/warc"
    warc.write_archives(warc.classify(df.repartition(2), "page_id", "html", "url"), path, **options)
    return warc.read_archives(spark, path).collect()


@pytest.mark.parametrize("split, compression", [(1 << 27, "none"), (700, "none"), (1 << 27, "gzip")])
def test_round_trip(spark, split, compression):
    texts = ["", None, "plain", "plain", INNER, INNER * 30, "x" * 5000 + INNER, "é\r\n\r\nWARC/1.", "WARC/1.0\r\n" * 400, "plain", "y" * 3000]
    rows = [(i, f"http://h/{i}\nWARC/1.0" if i % 2 else None, t, "clash", "clash") for i, t in enumerate(texts)] + [(None, "u", "no id", "", "")]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["id"]: r for r in round_trip(spark, rows, compression=compression)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == len(rows)
    first = {}
    for i, url, text, *_ in rows:
        text = text or ""
        r = got[i]
        assert (r["payload_bytes"], r["digest"]) == (len(text.encode()), digest(text))
        if text in first:
            assert (r["record_type"], r["refers_to"]) == ("revisit", first[text])
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"]).decode()) == ("response", None, text)
        first.setdefault(text, i)
        assert r["url"] == (url and url.replace("\n", "%0A").replace("WARC/1.", "%57ARC/1."))
        assert r["intact"] and not r["truncated"]


@pytest.mark.parametrize("split, compression", [(1 << 27, "none"), (30_000, "none"), (1 << 27, "gzip")])
def test_long_urls(spark, split, compression):
    rows = [(i, "data:," + "u\n"[i % 2] * 100_000 if i % 3 == 0 else "u", f"text {i} {INNER}", "", "") for i in range(12)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = {r["id"]: (r["url"], bytes(r["payload"]).decode(), r["intact"], r["truncated"]) for r in round_trip(spark, rows, compression=compression)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: (url.replace("\n", "%0A"), text, True, False) for i, url, text, *_ in rows}


def test_what_is_no_header():
    assert warc._fields(b"no header") == (None, None, None, None, b"no header", 9, None, False, False)
    cut_off = warc._fields(b"0\r\nWARC-Type: response\r\nWARC-Target-URI: u\r\nWARC-X-Payload-Length: ")
    assert (cut_off[0], cut_off[2], cut_off[4], cut_off[8]) == ("response", "u", b"", True)


def test_small_payloads_are_not_revisited(spark):
    df = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    kinds = {r["id"]: r["record_type"] for r in warc.classify(df, "page_id", "html", "url", min_bytes=3).collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_empty_table(spark):
    assert round_trip(spark, []) == []


def test_query_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = sorted(con.sql(queries.ORACLE_SQL["op2_warc"]).fetchall())
    assert sorted(tuple(r) for r in queries.op2_warc(spark, sf_dir).collect()) == want


def copied_pages(spark):
    """100 pages, of which ten have one text and the others texts of their own."""
    return spark.createDataFrame([(i, "u", "same" if i % 10 == 3 else f"text {i}") for i in range(100)],
                                 "page_id long, url string, html string").repartition(4)


def walk(nodes):
    return [found for name, plan, inputs in nodes for found in [(name, plan), *(below for i in inputs for below in walk(i))]]


def test_single_payloads_are_not_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = warc.classify(warc.stored(copied_pages(spark), "pages"), "page_id", "html", "url")
        run_in_place(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    shuffled = [plan.metrics().apply("shuffleRecordsWritten").value()
                for name, plan in walk(plan_nodes(rows._jdf.queryExecution().executedPlan()))
                if name == "Exchange" and "payload#" in plan.output().toString()]
    assert shuffled == [10]


@pytest.mark.parametrize("bits", [1 << 26, 8, 1])
def test_single_payloads_marked_by_chance(spark, monkeypatch, bits):
    monkeypatch.setattr(warc, "MARK_BITS", bits)
    got = {r["id"]: (r["record_type"], r["refers_to"], bytes(r["payload"]).decode())
           for r in warc.classify(copied_pages(spark), "page_id", "html", "url").collect()}
    assert got == {i: ("revisit" if i % 10 == 3 and i > 3 else "response", 3 if i % 10 == 3 and i > 3 else None,
                       "same" if i % 10 == 3 else f"text {i}") for i in range(100)}
