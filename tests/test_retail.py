"""The derived retail tables grow with their input, cover its calendar and are
rebuilt when it changes."""

import shutil

import pytest
from pyspark.sql import functions as F

from aisle.plans.suite.rollups import _rank_in_parent
from aisle.session import ensure_checkpoint_dir
from aisle.sources import retail
from aisle.sources.retail import retail_tables

SMALL = "/root/testdata/sf0.001"


def test_dimensions_hold_every_source_row(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    parts, customers = (spark.read.parquet(f"{sf_dir}/{n}.parquet").count() for n in ("part", "customer"))
    assert t["item"].count() == t["item"].select("i_item_sk").distinct().count() == parts
    assert t["customer"].count() == t["customer"].select("c_customer_sk").distinct().count() == customers
    assert t["customer_address"].count() == 2 * customers
    brands = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand")
    assert t["item"].join(brands, F.col("p_partkey") == F.col("i_item_sk")).where("p_brand <> i_brand").isEmpty()


def test_every_date_and_key_is_in_its_dimension(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    days = t["date_dim"].select(F.col("d_date_sk").alias("day"))
    for fact, key in retail.FACT_DATE_KEY.items():
        assert t[fact].join(days, F.col(key) == F.col("day"), "left_anti").isEmpty(), fact
    for fact, p in (("store_sales", "ss"), ("catalog_returns", "cr")):
        assert t[fact].join(t["item"], F.col(f"{p}_item_sk") == F.col("i_item_sk"), "left_anti").isEmpty()
    assert t["store_sales"].join(t["customer"], F.col("ss_customer_sk") == F.col("c_customer_sk"), "left_anti").isEmpty()


def _folder_input(spark, root):
    for n in ("lineitem", "orders", "part", "customer"):
        spark.read.parquet(f"{SMALL}/{n}.parquet").repartition(3).write.parquet(f"{root}/{n}.parquet")
    return root


def test_a_changed_file_means_a_rebuild(spark, tmpdir_path):
    root = _folder_input(spark, f"{tmpdir_path}/in")
    before = retail_tables(spark, root)["store_sales"].count()
    version = retail._fingerprint(spark, root)
    assert retail._fingerprint(spark, root) == version
    more = spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(600).withColumn("l_partkey", (F.col("l_partkey") + 7) % 200)
    more.coalesce(1).write.mode("append").parquet(f"{root}/lineitem.parquet")
    assert retail._fingerprint(spark, root) != version
    assert retail_tables(spark, root)["store_sales"].count() > before


def test_keys_that_are_not_dense_are_refused(spark, tmpdir_path):
    root = _folder_input(spark, f"{tmpdir_path}/in")
    gap = spark.read.parquet(f"{SMALL}/part.parquet").where("p_partkey <> 5")
    gap.write.parquet(f"{tmpdir_path}/part")
    shutil.copytree(f"{tmpdir_path}/part", f"{root}/part.parquet", dirs_exist_ok=True)
    with pytest.raises(ValueError, match="part"):
        retail.input_sizes(spark, root)


def test_ranks_tell_apart_what_rounding_would_tie(spark):
    rows = [("a", "x", 0, 0, 0.12340001), ("a", "y", 0, 0, 0.12340002), ("a", "z", 0, 0, 0.12340002)]
    df = spark.createDataFrame(rows, "i_category string, i_class string, g_i_class int, lochierarchy int, gross_margin double")
    ranks = {r["i_class"]: r["rank_within_parent"] for r in _rank_in_parent(df, "i_category", "i_class", "gross_margin", True).collect()}
    assert ranks == {"x": 1, "y": 2, "z": 2}


class _Cluster:
    """A session of a cluster without a shared folder."""

    class conf:
        get = staticmethod(lambda name, default=None: default)

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster)
