"""Delimited text ingest: short rows, empty fields, bad values, extra
fields, latin-1 bytes, NOT NULL keys and the reject limit."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.sources.delimited import (RejectLimitExceeded, ingest, read_delimited, read_raw, split_rejects, stored_splits,
                                     typed_with_reason)
from aisle.sources.retail import TABLES
from aisle.sources.schemas import retail_schema

SCHEMA = T.StructType([T.StructField("k", T.IntegerType(), False), T.StructField("name", T.StringType(), True),
                       T.StructField("price", T.DecimalType(7, 2), True)])


def _write(path, lines, encoding="latin-1"):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.dat"), "w", encoding=encoding, newline="\n") as f:
        f.write("\n".join(lines) + "\n")


def test_rows_and_reasons(spark, tmpdir_path):
    _write(tmpdir_path, ["1|a|2.50", "2|b", "3||x", "4|c|1.00|zz", "5|café|3.00", "|d|1.00", "6||"])
    good, bad = split_rejects(read_raw(spark, tmpdir_path, SCHEMA), SCHEMA, check=False)
    g = {r["k"]: (r["name"], r["price"]) for r in good.collect()}
    assert g[1] == ("a", __import__("decimal").Decimal("2.50"))
    assert g[2] == ("b", None)              # short row: missing field is NULL
    assert g[5][0] == "café"            # latin-1 byte decoded
    assert g[6] == (None, None)              # empty fields are NULL
    reasons = {r["_reject"] for r in bad.collect()}
    assert reasons == {"bad value in price", "too many fields", "NULL in NOT NULL k"}
    assert good.count() == 4 and bad.count() == 3


@pytest.mark.parametrize("n_bad,ok", [(9, True), (10, True), (11, False)])
def test_reject_limit(spark, tmpdir_path, n_bad, ok):
    lines = [f"{i}|n{i}|1.00" for i in range(1000 - n_bad)] + [f"{i}|n|oops" for i in range(n_bad)]
    _write(tmpdir_path, lines)
    if ok:
        assert read_delimited(spark, tmpdir_path, SCHEMA, max_pct=1.0).count() == 1000 - n_bad
    else:
        with pytest.raises(RejectLimitExceeded):
            read_delimited(spark, tmpdir_path, SCHEMA, max_pct=1.0)


def _lines(n, bad, start=0):
    return [f"{start + i}|n{i}|{'oops' if i < bad else '1.00'}" for i in range(n)]


@pytest.mark.parametrize("early", [False, True])
def test_one_bad_split_fails_a_good_table(spark, tmpdir_path, early):
    """0.06 % of the table, but 2 % of one file."""
    for i in range(9):
        _write(f"{tmpdir_path}/t/f{i}", _lines(2000, 0, 10000 * i))
    _write(f"{tmpdir_path}/t/f9", _lines(600, 12, 10000 * 9))
    raw = read_raw(spark, f"{tmpdir_path}/t/*", SCHEMA)
    with pytest.raises(Exception, match="rejected") as raised:
        ingest(raw, SCHEMA, f"{tmpdir_path}/out", early=early)
    assert early or isinstance(raised.value, RejectLimitExceeded)
    if not early:
        splits = stored_splits(spark, f"{tmpdir_path}/out").collect()
        assert sorted((r["row_count"], r["reject_count"]) for r in splits) == [(600, 12)] + [(2000, 0)] * 9
        assert [r["reject_count"] for r in splits if "/f9/" in r["_file"]] == [12]
    good, bad = ingest(raw, SCHEMA, f"{tmpdir_path}/out2", max_pct=2.0, early=early)
    assert (good.count(), bad.count(), good.columns) == (18588, 12, SCHEMA.fieldNames())
    assert {r["_reject"] for r in bad.collect()} == {"bad value in price"}


def test_small_splits_count_with_the_table(spark, tmpdir_path):
    """A file of 299 records is no sample; with 300 its share counts."""
    _write(f"{tmpdir_path}/a/big", _lines(5000, 0))
    _write(f"{tmpdir_path}/a/small", _lines(299, 20, 10000))
    assert read_delimited(spark, f"{tmpdir_path}/a/*", SCHEMA).count() == 5279
    _write(f"{tmpdir_path}/b/big", _lines(5000, 0))
    _write(f"{tmpdir_path}/b/small", _lines(300, 20, 10000))
    with pytest.raises(RejectLimitExceeded, match="small.*20 of 300"):
        read_delimited(spark, f"{tmpdir_path}/b/*", SCHEMA)
    with pytest.raises(RejectLimitExceeded, match="20 of 300"):
        split_rejects(read_raw(spark, f"{tmpdir_path}/b/*", SCHEMA), SCHEMA)


def test_splits_of_one_file(spark, tmpdir_path):
    """The blocks of a large file are judged apart."""
    _write(tmpdir_path, _lines(20000, 0) + _lines(1000, 100, 50000) + _lines(20000, 0, 60000))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        raw = read_raw(spark, tmpdir_path, SCHEMA)
        with pytest.raises(RejectLimitExceeded):
            ingest(raw, SCHEMA, f"{tmpdir_path}-out")
        splits = stored_splits(spark, f"{tmpdir_path}-out").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(splits) > 5 and sum(r["row_count"] for r in splits) == 41000
    assert sum(r["reject_count"] for r in splits) == 100 and sum(r["reject_count"] > 0 for r in splits) <= 2


def test_empty_text(spark, tmpdir_path):
    os.makedirs(tmpdir_path, exist_ok=True)
    open(os.path.join(tmpdir_path, "part-0.dat"), "w").close()
    good, bad = ingest(read_raw(spark, tmpdir_path, SCHEMA), SCHEMA, f"{tmpdir_path}-out")
    assert good.count() == bad.count() == 0


def test_code_of_wide_tables_is_compiled(spark, tmpdir_path):
    """The JVM compiles no method above 8,000 bytes: it would interpret the
    conversion of every row."""
    _write(tmpdir_path, ["1|2"])
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for name in TABLES:
        schema = retail_schema(name)
        plan = typed_with_reason(read_raw(spark, tmpdir_path, schema), schema)._jdf.queryExecution().executedPlan()
        parts = debug.codegenStringSeq(plan)
        assert all(parts.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(parts.size())), name


def test_reasons_of_whole_schemas(spark, tmpdir_path):
    """Each kind of value is converted once, and the first reason is named."""
    schema = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("d", T.DateType(), True),
                           T.StructField("s", T.StringType(), False), T.StructField("_typed", T.DecimalType(7, 2), True)])
    _write(tmpdir_path, ["1|2000-01-02|a|1.5", "x|2000-99-02||y", "2|2000-99-02|b|1", "3||", "4||c|123456.00", "5||d|1|z"])
    good, bad = split_rejects(read_raw(spark, tmpdir_path, schema), schema, check=False)
    assert [str(v) for v in good.first()] == ["1", "2000-01-02", "a", "1.50"] and good.columns == schema.fieldNames()
    assert sorted((r["k"] or 0, r["_reject"]) for r in bad.collect()) == [
        (0, "bad value in k"), (2, "bad value in d"), (3, "NULL in NOT NULL s"), (4, "bad value in _typed"), (5, "too many fields")]


def test_a_load_sorts_nothing_and_tells_rejects_by_their_reason(spark, tmpdir_path):
    """Folders for good and bad records would make each task sort its rows."""
    _write(f"{tmpdir_path}/t", _lines(2000, 7))
    good, bad = ingest(read_raw(spark, f"{tmpdir_path}/t", SCHEMA), SCHEMA, f"{tmpdir_path}/out")
    assert not [f for f in os.listdir(f"{tmpdir_path}/out") if os.path.isdir(f"{tmpdir_path}/out/{f}")]
    assert (good.count(), bad.count()) == (1993, 7)
    assert good.columns == SCHEMA.fieldNames() and bad.columns == [*SCHEMA.fieldNames(), "_reject", "_file", "_block"]


@pytest.mark.parametrize("job", ["src_delimited", "src_reject_limit", "src_reject_split"])
def test_staged_text_goes_when_its_load_has_ended(spark, tmpdir_path, monkeypatch, job):
    """The disk holds the staged text of one table at a time, compressed."""
    from aisle.plans import pipeline
    name = "store_returns"
    table = spark.range(3000).select(*[(F.col("id") if f.dataType.typeName() in ("integer", "long") else F.lit(1)).cast(f.dataType).alias(f.name)
                                       for f in retail_schema(name).fields])
    monkeypatch.setattr(pipeline, "derived_tables", lambda *a: {name: table})
    monkeypatch.setattr(pipeline, "TABLES", [name])
    monkeypatch.setattr(pipeline, "FACTS", [name])
    monkeypatch.setattr(pipeline, "_work", lambda s, d, n: f"{tmpdir_path}/{n}")
    staged = []
    real = pipeline.delimited.ingest

    def ingest_of(*a, **k):
        staged.extend(f for _, _, names in os.walk(tmpdir_path) for f in names if f.startswith("part-") and "parquet" not in f)
        return real(*a, **k)
    monkeypatch.setattr(pipeline.delimited, "ingest", ingest_of)
    row = getattr(pipeline, job)(spark, "").first()
    assert staged and all(f.endswith(".snappy") for f in staged)
    left = [f for _, _, names in os.walk(tmpdir_path) for f in names if f.startswith("part-")]
    assert left and all(f.endswith(".parquet") for f in left)
    hits = [i for i in range(3000) if 2 * i % 499 == 0]
    assert {"src_delimited": ("row_count", 3000), "src_reject_limit": ("rejected_rows", len(hits)), "src_reject_split": ("load_failed", True)}[job] \
        in row.asDict().items()
