"""The kit's workflow through the library the command line uses: stage the
tables as text, load them typed, and run suite statements on the loaded
tables (which are then read as they are, not derived again)."""

from pyspark.sql import functions as F

from aisle.plans.runs import run_power
from aisle.sinks import jobs, tables
from aisle.sources import delimited
from aisle.sources.retail import TABLES, retail_tables
from aisle.sources.schemas import retail_schema


def test_stage_load_query(spark, tmpdir_path):
    small = "/root/testdata/sf0.001"
    t = retail_tables(spark, small)
    pairs = {}
    for n in TABLES:
        delimited.write_delimited(t[n], f"{tmpdir_path}/text/{n}")
        good = delimited.read_delimited(spark, f"{tmpdir_path}/text/{n}", retail_schema(n))
        tables.load_table(good, f"{tmpdir_path}/tables/{n}")
        pairs[n] = (t[n], spark.read.parquet(f"{tmpdir_path}/tables/{n}"))
    rec = jobs.reconcile(spark, pairs)
    assert rec.filter(~F.col("ok")).count() == 0
    loaded = retail_tables(spark, f"{tmpdir_path}/tables")
    assert loaded["store_sales"].count() == t["store_sales"].count()
    rep = {r["query"]: r for r in run_power(spark, f"{tmpdir_path}/tables", num="96,7", with_digest=True).collect()}
    direct = {r["query"]: r for r in run_power(spark, small, num="96,7", with_digest=True).collect()}
    assert {k: v["digest"] for k, v in rep.items()} == {k: v["digest"] for k, v in direct.items()}
