"""What a statement derives, and how its work is cut, follows what it reads
and the size of the input."""

import os

from pyspark.sql import functions as F

from aisle.plans.registry import load_all
from aisle.sinks.tables import cluster_for_write
from aisle.sources import delimited, retail
from aisle.sources.retail import Sizes, derived_tables, retail_tables, size_shuffles
from aisle.sources.schemas import retail_schema

SMALL = "/root/testdata/sf0.001"


def _own_input(spark, root):
    for n in ("lineitem", "orders", "part", "customer"):
        spark.read.parquet(f"{SMALL}/{n}.parquet").write.parquet(f"{root}/{n}.parquet")
    return root


def _stored(spark, sf_dir):
    root = f"{retail._checkpoint_root(spark)}/aisle-retail/{retail._fingerprint(spark, sf_dir)}-flat"
    return {n.removesuffix("-builds") for n in os.listdir(root)} if os.path.isdir(root) else set()


def test_a_table_is_stored_when_it_is_asked_for(spark, tmpdir_path):
    root = _own_input(spark, f"{tmpdir_path}/in")
    load_all()["q98"].fn(spark, root).count()
    assert _stored(spark, root) == {"sale_base_store", "store_sales", "item", "date_dim"}
    assert retail_tables(spark, root)["web_returns"].count() > 0
    assert _stored(spark, root) == {"sale_base_store", "store_sales", "item", "date_dim", "sale_base_web", "web_returns"}


def test_table_jobs_do_not_store_the_tables_first(spark, tmpdir_path):
    root = _own_input(spark, f"{tmpdir_path}/in")
    views = derived_tables(spark, root)
    counts = {n: views[n].count() for n in ("catalog_sales", "catalog_returns", "inventory", "customer_address")}
    assert _stored(spark, root) == {"sale_base_catalog"}
    for n, rows in counts.items():
        table = retail_tables(spark, root)[n]
        assert table.columns == views[n].columns and table.count() == rows
        assert table.exceptAll(views[n]).isEmpty()


def test_an_unfinished_build_is_not_read(spark, tmpdir_path):
    root = _own_input(spark, f"{tmpdir_path}/in")
    tables = retail_tables(spark, root)
    os.makedirs(f"{tables._builds('store')}/0/store")
    assert tables.path("store") is None
    assert tables["store"].count() == 12 and "/0/store" not in tables.path("store")


def test_inventory_is_dealt_by_its_rows(spark):
    """The parts of one small file are hundreds of times as many rows."""
    def tasks(parts):
        sizes = Sizes(0, 0, 0, parts)
        return retail.build_table(spark, SMALL, "inventory", None, sizes).rdd.getNumPartitions()
    assert tasks(10_000) < tasks(1_200_000) == 126


def test_shuffles_are_cut_by_the_input(spark):
    before = spark.conf.get(retail.SHUFFLE_PARTITIONS, None)
    try:
        size_shuffles(spark, 1 << 30)
        assert int(spark.conf.get(retail.SHUFFLE_PARTITIONS)) == 256
        size_shuffles(spark, 1 << 20)
        assert spark.conf.get(retail.SHUFFLE_PARTITIONS, None) is None
        spark.conf.set(retail.SHUFFLE_PARTITIONS, "3")      # the session's own choice stays
        size_shuffles(spark, 1 << 30)
        assert spark.conf.get(retail.SHUFFLE_PARTITIONS) == "3"
    finally:
        spark.conf.unset(retail.SHUFFLE_PARTITIONS)
        if before:
            spark.conf.set(retail.SHUFFLE_PARTITIONS, before)


def test_slices_are_cut_without_reading_whole_rows_twice(spark):
    df = spark.range(500_000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 5).cast("int").alias("k"),
                                     F.col("id").alias("v")).withColumn("p", F.coalesce("k", F.lit(-1)))
    out = cluster_for_write(df, "p", "k")
    assert "rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.columns == df.columns and out.exceptAll(df).isEmpty() and out.count() == 500_000
    per_task = out.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n"), F.countDistinct("p").alias("p")).collect()
    assert len(per_task) == 5 and all(r["n"] < 110_000 and r["p"] <= 3 for r in per_task)


def test_distribution_counts_keys_in_more_slices_than_parts(spark, tmpdir_path):
    root = _own_input(spark, f"{tmpdir_path}/in")
    df = load_all()["sink_distribution"].fn(spark, root, n=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 14
    assert all(r["split_keys"] == 0 and r["row_count"] >= r["key_count"] > 0 for r in df.collect())


def test_gzip_text_reads_back(spark, tmpdir_path):
    t = derived_tables(spark, SMALL)["store"]
    delimited.write_delimited(t, f"{tmpdir_path}/text", compression="gzip")
    assert any(f.endswith(".gz") for f in os.listdir(f"{tmpdir_path}/text"))
    back = delimited.read_delimited(spark, f"{tmpdir_path}/text", retail_schema("store"), store=f"{tmpdir_path}/typed")
    assert back.exceptAll(t).isEmpty() and back.count() == t.count()
