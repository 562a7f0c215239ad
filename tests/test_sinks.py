"""Storage options, money type, bucketed co-location, statistics."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from aisle.sinks import jobs, tables
from aisle.sources.retail import retail_tables
from aisle.sources.schemas import fact_schema


def test_codec_and_money(spark, sf_dir, tmpdir_path):
    ss = retail_tables(spark, sf_dir)["store_sales"]
    for codec in ("none", "snappy"):
        path = os.path.join(tmpdir_path, codec)
        tables.load_table(ss, path, tables.write_options("parquet", 8192, codec))
        names = [f for f in os.listdir(path) if f.endswith(".parquet")]
        assert names and all((".snappy." in f) == (codec == "snappy") for f in names)
        assert spark.read.parquet(path).count() == ss.count()
    dbl = tables.with_money(ss, "double")
    assert dict(dbl.dtypes)["ss_net_paid"] == "double"
    assert dict(zip(fact_schema("store_sales", "double").fieldNames(),
                    [f.dataType.simpleString() for f in fact_schema("store_sales", "double")]))["ss_net_paid"] == "double"


def test_bucketed_tables_join_without_shuffle(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    tables.save_bucketed(t["store_sales"].select("ss_item_sk", "ss_ticket_number", "ss_net_paid"), "b_ss",
                         ["ss_item_sk", "ss_ticket_number"], 8)
    tables.save_bucketed(t["store_returns"].select("sr_item_sk", "sr_ticket_number", "sr_return_amt"), "b_sr",
                         ["sr_item_sk", "sr_ticket_number"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("b_ss").join(spark.table("b_sr"), (F.col("ss_item_sk") == F.col("sr_item_sk"))
                                     & (F.col("ss_ticket_number") == F.col("sr_ticket_number")))
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        assert "SortMergeJoin" in buf.getvalue() and "Exchange" not in buf.getvalue()
        assert j.count() == t["store_returns"].count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_table_stats_exact_and_estimate(spark, sf_dir):
    ss = retail_tables(spark, sf_dir)["store_sales"].select("ss_item_sk", "ss_hdemo_sk")
    exact = {r["column_name"]: r for r in jobs.table_stats(ss, exact=True).collect()}
    est = {r["column_name"]: r for r in jobs.table_stats(ss).collect()}
    assert exact["ss_hdemo_sk"]["null_count"] > 0
    for c in ("ss_item_sk", "ss_hdemo_sk"):
        assert abs(est[c]["ndv"] - exact[c]["ndv"]) <= 0.1 * exact[c]["ndv"]
