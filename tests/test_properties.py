"""Properties of the operators on the driver's tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from aisle.operators import joins as J
from aisle.operators.aggs import lag_buckets, rollup_cascade, rollup_levels
from aisle.operators.windows import global_rank_top, rank_in_groups, running
from aisle.sources.orderentry import OrderEntry


def test_rollup_grand_total(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    r = rollup_levels(t.li, ["l_returnflag", "l_linestatus"], [F.sum("l_quantity").alias("q")])
    grand = r.filter(F.col("lochierarchy") == 2).first()["q"]
    assert grand == t.li.agg(F.sum("l_quantity")).first()[0]


def test_semi_plus_anti_is_all(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    r = t.li.filter(F.col("l_returnflag") == "R")
    semi = J.semi(t.od, r, ["o_orderkey"], ["l_orderkey"]).count()
    anti = J.not_exists(t.od, r, ["o_orderkey"], ["l_orderkey"]).count()
    assert semi + anti == t.od.count() and semi > 0 and anti > 0


def test_semi_other_matches_pairwise(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    fast = J.semi_other(t.li, t.li, "l_orderkey", "l_suppkey", "l_orderkey", "l_suppkey").count()
    l2 = t.li.select(F.col("l_orderkey").alias("o2"), F.col("l_suppkey").alias("s2"))
    slow = t.li.join(l2, (F.col("l_orderkey") == F.col("o2")) & (F.col("l_suppkey") != F.col("s2")), "left_semi").count()
    assert fast == slow


def test_running_sum_last_is_total(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    d = t.od.groupBy("o_orderdate").agg(F.sum("o_totalprice").alias("v")).withColumn("p", F.lit(1))
    r = d.withColumn("cum", running(F.sum, "v", ["p"], ["o_orderdate"]))
    last = r.orderBy(F.col("o_orderdate").desc()).first()["cum"]
    assert last == d.agg(F.sum("v")).first()[0]


def test_buckets_cover_all_rows(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    j = t.li.join(t.od, F.col("l_orderkey") == F.col("o_orderkey"))
    row = j.agg(*lag_buckets(F.datediff("l_shipdate", "o_orderdate"))).first()
    assert sum(row) == j.count()


def test_global_rank_top_equals_window(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    g = t.li.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    fast = {(r["l_suppkey"], r["rnk"]) for r in global_rank_top(g, ["q"], [True], 10).collect()}
    full = g.withColumn("rnk", F.rank().over(Window.orderBy(F.col("q").desc()))).filter(F.col("rnk") <= 10)
    assert fast == {(r["l_suppkey"], r["rnk"]) for r in full.collect()}


def test_intersect_is_subset(spark, sf_dir):
    from aisle.plans.registry import load_all
    reg = load_all()
    inter = {r[0] for r in reg["op_intersect"].fn(spark, sf_dir).collect()}
    first = {r[0] for r in OrderEntry(spark, sf_dir).od.filter(F.year("o_orderdate") == 1996)
             .select("o_custkey").distinct().collect()}
    assert inter and inter <= first


def test_global_rank_top_random_ties(spark):
    """Random values with many ties and NULLs: the bounded form gives exactly
    the rows (and ranks) of the full window, both orders."""
    import random
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None, 1, 2, 2, 3, 3, 3, 5, 8])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, v int")
    for desc_order in (False, True):
        for k in (1, 3, 10):
            o = F.col("v").desc_nulls_first() if desc_order else F.col("v").asc_nulls_last()
            full = df.withColumn("rnk", F.rank().over(Window.orderBy(o))).filter(F.col("rnk") <= k)
            fast = global_rank_top(df, ["v"], [desc_order], k)
            assert {(r["id"], r["rnk"]) for r in fast.collect()} == {(r["id"], r["rnk"]) for r in full.collect()}


@pytest.mark.parametrize("pieces", [1, 2, 7])
def test_rank_in_groups_equals_the_window(spark, pieces):
    rows = [(i, None if i % 11 == 0 else "ab"[i % 2], None if i % 17 == 0 else i * 7 % 23) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    for group in ([], ["g"]):
        w = Window.partitionBy(*group).orderBy(F.col("v").asc_nulls_last())
        want = {r["id"]: r["rk"] for r in df.withColumn("rk", F.rank().over(w)).collect()}
        got = rank_in_groups(df, group, "v", "rk", pieces)
        assert got.columns == ["id", "g", "v", "rk"] and {r["id"]: r["rk"] for r in got.collect()} == want
        assert rank_in_groups(df.limit(0), group, "v").collect() == []


def test_a_million_ties_rank_without_one_task(spark):
    df = spark.range(1_200_000).select("id", F.when(F.col("id") < 1_000_000, 5).otherwise(F.col("id") % 3 * 5).alias("v"))
    got = rank_in_groups(df, [], "v")
    per_value = got.groupBy("v").agg(F.min("rnk").alias("lo"), F.max("rnk").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("v").collect()
    at = 1
    for r in per_value:
        assert r["lo"] == r["hi"] == at
        at += r["n"]
    assert at == 1_200_001
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_" not in plan


@pytest.mark.parametrize("deal", [0, 1, 2, 3])
def test_rollup_cascade_equals_rollup(spark, deal):
    rows = [(None if i % 7 == 0 else i % 3, "x" if i % 5 else None, i % 4, i) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b string, c int, v int")
    keys = ["a", "b", "c"]
    got = rollup_cascade(df, keys, {"s": "v"}, deal)
    want = rollup_levels(df, keys, [F.sum("v").alias("s")]).drop("lochierarchy")
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert "Expand" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in rollup_cascade(df.limit(0), keys, {"s": "v"}, deal).collect()] == [(None, None, None, None, 1, 1, 1)]


def test_global_rank_top(spark):
    rows = [(i, None if i % 17 == 0 else float(i * 7 % 23)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v double")
    want = {r["id"]: r["rk"] for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").asc_nulls_last()))).collect()}
    top = global_rank_top(df, ["v"], [False], 20, "rk").collect()
    assert {r["id"]: r["rk"] for r in top} == {i: rk for i, rk in want.items() if rk <= 20}
