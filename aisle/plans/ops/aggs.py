"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import avg4, mean, money_sum, quotient4, r4, stddev4
from ...operators.aggs import lag_buckets, pivot_sums, rollup_cascade, rollup_levels
from ...sources.orderentry import OrderEntry
from ..registry import register

c = F.col


@register("op_agg_sum", prelude="ops", sql="""
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS sum_qty,
       CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS sum_price
FROM li GROUP BY l_returnflag, l_linestatus""")
def op_agg_sum(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").cast("bigint").alias("sum_qty"), money_sum("l_extendedprice").alias("sum_price"))


@register("op_agg_avg", prelude="ops", sql="""
SELECT l_returnflag, round(CAST(sum(l_quantity) * 10000 AS DOUBLE) / count(l_quantity)) / 10000 AS avg_qty,
       round(CAST(sum(l_extendedprice) * 10000 AS DOUBLE) / count(l_extendedprice)) / 10000 AS avg_price,
       round(CAST(sum(l_discount) * 10000 AS DOUBLE) / count(l_discount)) / 10000 AS avg_disc
FROM li GROUP BY l_returnflag""")
def op_agg_avg(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy("l_returnflag").agg(avg4("l_quantity").alias("avg_qty"),
                                            avg4("l_extendedprice").alias("avg_price"),
                                            avg4("l_discount").alias("avg_disc"))


@register("op_agg_count_star", prelude="ops", sql="""
SELECT o_orderpriority, count(*) AS n FROM od GROUP BY o_orderpriority""")
def op_agg_count_star(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.od.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@register("op_agg_count_col", prelude="ops", sql="""
SELECT c_mktsegment, count(*) AS rows_n, count(o_orderkey) AS orders_n
FROM cu LEFT JOIN od ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
GROUP BY c_mktsegment""")
def op_agg_count_col(spark, sf_dir):
    """``count(col)`` skips NULLs (customers without a matching order)."""
    t = OrderEntry(spark, sf_dir)
    o = t.od.filter(c("o_orderpriority") == "1-URGENT")
    j = t.cu.join(o, c("c_custkey") == c("o_custkey"), "left")
    return j.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows_n"),
                                         F.count("o_orderkey").alias("orders_n"))


@register("op_agg_max", prelude="ops", sql="""
SELECT o_orderstatus, max(o_totalprice) AS max_price, max(o_orderdate) AS last_date
FROM od GROUP BY o_orderstatus""")
def op_agg_max(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.od.groupBy("o_orderstatus").agg(F.max("o_totalprice").alias("max_price"),
                                             F.max("o_orderdate").alias("last_date"))


@register("op_agg_stddev", prelude="ops", sql="""
SELECT l_suppkey, round(CAST(stddev_samp(l_quantity) AS DOUBLE), 4) AS sd_qty,
       round(CAST(stddev_samp(l_quantity) / avg(l_quantity) AS DOUBLE), 4) AS cov_qty
FROM li GROUP BY l_suppkey""")
def op_agg_stddev(spark, sf_dir):
    """Sample standard deviation and coefficient of variation per supplier."""
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy("l_suppkey").agg(
        stddev4("l_quantity").alias("sd_qty"),
        r4(F.stddev_samp("l_quantity") / mean("l_quantity")).alias("cov_qty"))


@register("op_agg_count_distinct", prelude="ops", sql="""
SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers
FROM li GROUP BY l_returnflag""")
def op_agg_count_distinct(spark, sf_dir):
    """Two exact distinct counts side by side (Catalyst expands the rows once
    per distinct column and aggregates in two shuffles)."""
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"),
                                            F.count_distinct("l_suppkey").alias("suppliers"))


@register("op_agg_global", prelude="ops", sql="""
SELECT count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty,
       CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
       round(CAST(sum(l_discount) * 10000 AS DOUBLE) / count(l_discount)) / 10000 AS avg_disc
FROM li""")
def op_agg_global(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.li.agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"),
                    money_sum("l_extendedprice").alias("revenue"), avg4("l_discount").alias("avg_disc"))


_PRIOS = {"urgent": "1-URGENT", "high": "2-HIGH", "medium": "3-MEDIUM",
          "not_spec": "4-NOT SPECIFIED", "low": "5-LOW"}


@register("op_agg_conditional_sum", prelude="ops", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr,
""" + ",\n".join(f"  CAST(sum(CASE WHEN o_orderpriority = '{v}' THEN o_totalprice END) AS DECIMAL(38,2)) AS {a}"
                 for a, v in _PRIOS.items()) + """
FROM od GROUP BY year(o_orderdate)""")
def op_agg_conditional_sum(spark, sf_dir):
    """Pivot by CASE inside SUM: one pass, one shuffle keyed by year."""
    t = OrderEntry(spark, sf_dir)
    cols = [x.cast("decimal(38,2)").alias(a) for x, a in
            zip(pivot_sums("o_orderpriority", _PRIOS, "o_totalprice"), _PRIOS)]
    return t.od.groupBy(F.year("o_orderdate").alias("yr")).agg(*cols)


@register("op_agg_lag_buckets", prelude="ops", sql="""
SELECT o_orderpriority,
  CAST(sum(CASE WHEN l_shipdate - o_orderdate <= 30 THEN 1 ELSE 0 END) AS BIGINT) AS d30,
  CAST(sum(CASE WHEN l_shipdate - o_orderdate > 30 AND l_shipdate - o_orderdate <= 60 THEN 1 ELSE 0 END) AS BIGINT) AS d31_60,
  CAST(sum(CASE WHEN l_shipdate - o_orderdate > 60 AND l_shipdate - o_orderdate <= 90 THEN 1 ELSE 0 END) AS BIGINT) AS d61_90,
  CAST(sum(CASE WHEN l_shipdate - o_orderdate > 90 AND l_shipdate - o_orderdate <= 120 THEN 1 ELSE 0 END) AS BIGINT) AS d91_120,
  CAST(sum(CASE WHEN l_shipdate - o_orderdate > 120 THEN 1 ELSE 0 END) AS BIGINT) AS d_gt120
FROM li JOIN od ON l_orderkey = o_orderkey
GROUP BY o_orderpriority""")
def op_agg_lag_buckets(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    j = t.li.join(t.od, c("l_orderkey") == c("o_orderkey"))
    diff = F.datediff("l_shipdate", "o_orderdate")
    return j.groupBy("o_orderpriority").agg(*lag_buckets(diff))


@register("op_agg_count_case", prelude="ops", sql="""
SELECT l_returnflag,
       count(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS count_all,
       count(CASE WHEN l_quantity > 25 THEN 1 END) AS count_big
FROM li GROUP BY l_returnflag""")
def op_agg_count_case(spark, sf_dir):
    """COUNT over a CASE that has an ELSE branch counts every row (kept as is)."""
    t = OrderEntry(spark, sf_dir)
    big = c("l_quantity") > 25
    return t.li.groupBy("l_returnflag").agg(F.count(F.when(big, 1).otherwise(0)).alias("count_all"),
                                            F.count(F.when(big, 1)).alias("count_big"))


@register("op_agg_expr", prelude="ops", sql="""
SELECT l_returnflag,
  CAST(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS DECIMAL(38,6)) AS charge,
  round(CAST(sum(l_extendedprice * l_discount) * 100000000 AS DOUBLE) / CAST(sum(l_extendedprice) * 10000 AS DOUBLE)) / 10000 AS disc_share
FROM li GROUP BY l_returnflag""")
def op_agg_expr(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    p, d, x = c("l_extendedprice"), c("l_discount"), c("l_tax")
    return t.li.groupBy("l_returnflag").agg(
        F.sum(p * (1 - d) * (1 + x)).cast("decimal(38,6)").alias("charge"),
        quotient4(F.sum(p * d), F.sum(p), 4).alias("disc_share"))


@register("op_agg_of_agg", prelude="ops", sql="""
SELECT c_mktsegment, round(CAST(sum(total) * 10000 AS DOUBLE) / count(total)) / 10000 AS avg_customer_total,
       max(n_orders) AS max_orders
FROM (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n_orders FROM od GROUP BY o_custkey) x
JOIN cu ON o_custkey = c_custkey
GROUP BY c_mktsegment""")
def op_agg_of_agg(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    per = t.od.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"),
                                        F.count(F.lit(1)).alias("n_orders"))
    j = per.join(t.cu, c("o_custkey") == c("c_custkey"))
    return j.groupBy("c_mktsegment").agg(avg4("total").alias("avg_customer_total"),
                                         F.max("n_orders").alias("max_orders"))


@register("op_having", prelude="ops", sql="""
SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS qty, count(*) AS lines
FROM li GROUP BY l_orderkey
HAVING sum(l_quantity) > $min_qty AND count(*) BETWEEN 2 AND 7""")
def op_having(spark, sf_dir, min_qty=150):
    t = OrderEntry(spark, sf_dir)
    return (t.li.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("bigint").alias("qty"),
                                           F.count(F.lit(1)).alias("lines"))
            .filter((c("qty") > min_qty) & c("lines").between(2, 7)))


@register("op_group_expr", prelude="ops", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, substr(o_orderpriority, 1, 1) AS prio, count(*) AS n
FROM od GROUP BY year(o_orderdate), substr(o_orderpriority, 1, 1)""")
def op_group_expr(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return (t.od.groupBy(F.year("o_orderdate").alias("yr"), F.substring("o_orderpriority", 1, 1).alias("prio"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("op_group_as_distinct", prelude="ops", sql="""
SELECT l_suppkey, l_returnflag FROM li GROUP BY l_suppkey, l_returnflag""")
def op_group_as_distinct(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.li.select("l_suppkey", "l_returnflag").dropDuplicates()


@register("op_distinct", prelude="ops", sql="""
SELECT DISTINCT p_type, p_size FROM pa""")
def op_distinct(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.pa.select("p_type", "p_size").distinct()


@register("op_rollup", prelude="ops", sql="""
SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS total,
       count(*) AS n
FROM od JOIN cu ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name, CAST(year(o_orderdate) AS INTEGER))""")
def op_rollup(spark, sf_dir):
    """Subtotals over three levels, each aggregated from the next finer one."""
    t = OrderEntry(spark, sf_dir)
    j = (t.od.join(t.cu, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey"))
         .join(t.region, c("n_regionkey") == c("r_regionkey")))
    base = j.select("r_name", "n_name", F.year("o_orderdate").alias("yr"), "o_totalprice", F.lit(1).alias("one"))
    keys = ["r_name", "n_name", "yr"]
    r = rollup_cascade(base, keys, {"total": "o_totalprice", "n": "one"})
    # without rows the grand total counts none of them
    return r.select(*keys, c("total").cast("decimal(38,2)").alias("total"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@register("op_grouping_flag", prelude="ops", sql="""
SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS qty,
       CAST(grouping(l_returnflag) AS INT) AS g_l_returnflag,
       CAST(grouping(l_linestatus) AS INT) AS g_l_linestatus,
       CAST(grouping(l_returnflag) + grouping(l_linestatus) AS INT) AS lochierarchy
FROM li GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def op_grouping_flag(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return rollup_levels(t.li, ["l_returnflag", "l_linestatus"],
                         [F.sum("l_quantity").cast("bigint").alias("qty")])
