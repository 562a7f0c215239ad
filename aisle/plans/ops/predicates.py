"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import money_sum
from ...sources.orderentry import OrderEntry
from ..registry import register


@register("op_project", prelude="ops", sql="""
SELECT l_orderkey, l_linenumber, 'L' AS src_tag, l_extendedprice AS price, l_quantity AS qty
FROM li""")
def op_project(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.li.select("l_orderkey", "l_linenumber", F.lit("L").alias("src_tag"),
                       F.col("l_extendedprice").alias("price"), F.col("l_quantity").alias("qty"))


@register("op_alias_quoted", prelude="ops", sql="""
SELECT l_returnflag AS "return flag", count(*) AS "line count",
       CAST(sum(l_quantity) AS BIGINT) AS "total qty"
FROM li GROUP BY l_returnflag""")
def op_alias_quoted(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return (t.li.groupBy(F.col("l_returnflag").alias("return flag"))
            .agg(F.count(F.lit(1)).alias("line count"),
                 F.sum("l_quantity").cast("bigint").alias("total qty")))


@register("op_compare", prelude="ops", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue
FROM li
WHERE l_quantity > $min_qty AND l_discount <> 0.05 AND l_shipdate <= DATE '$last_day'
  AND l_suppkey <= l_partkey AND l_tax < l_discount
GROUP BY l_returnflag, l_linestatus""")
def op_compare(spark, sf_dir, min_qty=25, last_day="1999-12-31"):
    t = OrderEntry(spark, sf_dir)
    c = F.col
    return (t.li.filter((c("l_quantity") > min_qty) & (c("l_discount") != F.lit(0.05).cast("decimal(4,2)"))
                        & (c("l_shipdate") <= F.lit(last_day).cast("date"))
                        & (c("l_suppkey") <= c("l_partkey")) & (c("l_tax") < c("l_discount")))
            .groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n"), money_sum("l_extendedprice").alias("revenue")))


@register("op_and_or", prelude="ops", sql="""
SELECT l_returnflag, l_linestatus, count(*) AS n
FROM li
WHERE (l_quantity BETWEEN 1 AND 10 AND l_discount >= 0.05)
   OR (l_quantity BETWEEN 40 AND 50 AND (l_returnflag = 'R' OR l_returnflag = 'A'))
   OR (l_linestatus = 'F' AND l_tax < 0.02 AND NOT (l_discount = 0))
GROUP BY l_returnflag, l_linestatus""")
def op_and_or(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    c = F.col
    cond = (((c("l_quantity").between(1, 10)) & (c("l_discount") >= 0.05))
            | ((c("l_quantity").between(40, 50)) & ((c("l_returnflag") == "R") | (c("l_returnflag") == "A")))
            | ((c("l_linestatus") == "F") & (c("l_tax") < 0.02) & ~(c("l_discount") == 0)))
    return t.li.filter(cond).groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@register("op_between", prelude="ops", sql="""
SELECT count(*) AS n, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue
FROM li
WHERE l_shipdate BETWEEN DATE '$lo' AND DATE '$hi'
  AND l_quantity BETWEEN 10 AND 10 + 10
  AND l_discount BETWEEN 0.01 + 0.02 AND 0.10 - 0.03""")
def op_between(spark, sf_dir, lo="1996-01-01", hi="1996-12-31"):
    t = OrderEntry(spark, sf_dir)
    c = F.col
    return (t.li.filter(c("l_shipdate").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))
                        & c("l_quantity").between(10, 10 + 10)
                        & c("l_discount").between(F.lit("0.03").cast("decimal(4,2)"),
                                                  F.lit("0.07").cast("decimal(4,2)")))
            .agg(F.count(F.lit(1)).alias("n"), money_sum("l_extendedprice").alias("revenue")))


@register("op_in_list", prelude="ops", sql="""
SELECT p_brand, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM li JOIN pa ON l_partkey = p_partkey
WHERE p_brand IN ($brands)
GROUP BY p_brand""")
def op_in_list(spark, sf_dir, brands=("Brand#1", "Brand#5", "Brand#5", "Brand#12", "Brand#20")):
    """IN list (with a repeated member, as the suite has); the filter lands
    on the small side of the join and is pushed into its scan."""
    t = OrderEntry(spark, sf_dir)
    pa = t.pa.filter(F.col("p_brand").isin(list(brands)))
    return (t.li.join(pa, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty")))


@register("op_like_prefix", prelude="ops", sql="""
SELECT p_type, count(*) AS n FROM pa
WHERE p_name LIKE '$prefix%' OR p_type LIKE 'S%'
GROUP BY p_type""")
def op_like_prefix(spark, sf_dir, prefix="blue"):
    t = OrderEntry(spark, sf_dir)
    return (t.pa.filter(F.col("p_name").like(f"{prefix}%") | F.col("p_type").startswith("S"))
            .groupBy("p_type").agg(F.count(F.lit(1)).alias("n")))


@register("op_is_null", prelude="ops", sql="""
SELECT c_mktsegment,
       count(CASE WHEN y.o_custkey IS NULL THEN 1 END) AS without_orders,
       count(CASE WHEN y.o_custkey IS NOT NULL THEN 1 END) AS with_orders
FROM cu LEFT JOIN (SELECT DISTINCT o_custkey FROM od WHERE year(o_orderdate) = $year) y
  ON c_custkey = y.o_custkey
GROUP BY c_mktsegment""")
def op_is_null(spark, sf_dir, year=1996):
    t = OrderEntry(spark, sf_dir)
    y = t.od.filter(F.year("o_orderdate") == year).select("o_custkey").distinct()
    j = t.cu.join(y, F.col("c_custkey") == F.col("o_custkey"), "left")
    return (j.groupBy("c_mktsegment")
            .agg(F.count(F.when(F.col("o_custkey").isNull(), 1)).alias("without_orders"),
                 F.count(F.when(F.col("o_custkey").isNotNull(), 1)).alias("with_orders")))


@register("op_date_string_compare", prelude="ops", sql="""
SELECT o_orderpriority, count(*) AS n FROM od
WHERE o_orderdate BETWEEN CAST('$start' AS DATE) AND CAST('$start' AS DATE) + 60
GROUP BY o_orderpriority""")
def op_date_string_compare(spark, sf_dir, start="1997-2-01"):
    """Date against a string with a one-digit month: cast explicitly."""
    t = OrderEntry(spark, sf_dir)
    d0 = F.lit(start).cast("date")
    return (t.od.filter(F.col("o_orderdate").between(d0, F.date_add(d0, 60)))
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")))
