"""Range partitions with an outlier partition, and load by partition."""

import pytest
from pyspark.sql import functions as F

from aisle.sinks.tables import OUTLIERS, load_partitions, write_range_partitioned

KEYS = [2450814, 2450815, 2450844, 2450845, 2453005, 2453006, None]


@pytest.mark.parametrize("days", [1, 30, 90])
def test_range_partitions(spark, tmpdir_path, days):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS)], "k int, v int")
    write_range_partitioned(df, "k", days, tmpdir_path)
    back = spark.read.parquet(tmpdir_path)
    got = {r["v"]: r["part_start"] for r in back.collect()}
    assert len(got) == len(KEYS)                                  # union of partitions = source
    assert got[0] == OUTLIERS and got[5] == OUTLIERS and got[6] == OUTLIERS
    assert got[1] == 2450815
    assert got[3] == 2450815 + ((2450845 - 2450815) // days) * days
    assert got[4] == 2450815 + ((2453005 - 2450815) // days) * days


def test_load_by_partition_drops_outliers(spark, tmpdir_path):
    df = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS)], "k int, v int")
    load_partitions(spark, df, "k", 30, tmpdir_path)
    back = spark.read.parquet(tmpdir_path)
    assert back.filter(F.col("part_start") == OUTLIERS).count() == 0
    assert back.count() == 4


def test_hot_range_is_split_over_tasks(spark, tmpdir_path):
    """Nine rows in ten fall into one range: the write spreads that range
    over several tasks (several files) instead of one."""
    import os
    n = 200_000
    df = spark.range(n).select(F.when(F.col("id") % 10 == 0, F.lit(2452000) + (F.col("id") % 500).cast("int"))
                               .otherwise(F.lit(2450900)).alias("k"), F.col("id"))
    # small test data: keep AQE from merging the range partitions back into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_range_partitioned(df, "k", 30, tmpdir_path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = [d for d in os.listdir(tmpdir_path) if d.startswith("part_start=2450875")][0]
    files = [f for f in os.listdir(os.path.join(tmpdir_path, hot)) if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(tmpdir_path).count() == n
