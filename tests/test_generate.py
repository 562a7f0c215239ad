"""Scale-out generation: copies of the input tables derive a proportionally
larger retail data set, and the suite runs on it."""

from aisle.plans.registry import load_all
from aisle.sinks.jobs import generate
from aisle.sources.retail import retail_tables


def test_generated_copies_scale_the_facts(spark, tmpdir_path):
    small = "/root/testdata/sf0.001"
    out = generate(spark, small, copies=3)
    for n, df in out.items():
        df.write.mode("overwrite").parquet(f"{tmpdir_path}/{n}.parquet")
    base = retail_tables(spark, small)["store_sales"].count()
    big = retail_tables(spark, tmpdir_path)["store_sales"].count()
    assert 2.5 * base <= big <= 3.5 * base
    orders = spark.read.parquet(f"{tmpdir_path}/orders.parquet")
    assert orders.select("o_orderkey").distinct().count() == orders.count()   # copies do not collide
    assert load_all()["q96"].fn(spark, tmpdir_path).count() == 1
