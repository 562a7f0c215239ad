"""Set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.sets import except_, intersect, union_all, union_distinct
from ...sources.orderentry import OrderEntry
from ..registry import register

c = F.col


def _cust_in_year(t, y):
    return t.od.filter(F.year("o_orderdate") == y).select(c("o_custkey").alias("custkey"))


@register("op_union_all", prelude="ops", sql="""
SELECT tag, count(*) AS n, CAST(sum(price) AS DECIMAL(38,2)) AS revenue FROM (
  SELECT 'returned' AS tag, l_extendedprice AS price FROM li WHERE l_returnflag = 'R'
  UNION ALL SELECT 'accepted' AS tag, l_extendedprice FROM li WHERE l_returnflag = 'A'
  UNION ALL SELECT 'open' AS tag, l_extendedprice FROM li WHERE l_linestatus = 'O') u
GROUP BY tag""")
def op_union_all(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    p = c("l_extendedprice").alias("price")
    u = union_all(t.li.filter(c("l_returnflag") == "R").select(F.lit("returned").alias("tag"), p),
                  t.li.filter(c("l_returnflag") == "A").select(F.lit("accepted").alias("tag"), p),
                  t.li.filter(c("l_linestatus") == "O").select(F.lit("open").alias("tag"), p))
    return u.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("decimal(38,2)").alias("revenue"))


@register("op_union_pad", prelude="ops", sql="""
SELECT k AS orderkey, CAST(sum(sales) AS DECIMAL(38,2)) AS sales, CAST(sum(returns) AS DECIMAL(38,2)) AS returns
FROM (SELECT l_orderkey AS k, l_extendedprice AS sales, CAST(0 AS DECIMAL(12,2)) AS returns FROM li
      WHERE l_returnflag <> 'R'
      UNION ALL
      SELECT l_orderkey AS k, CAST(0 AS DECIMAL(12,2)) AS sales, l_extendedprice AS returns FROM li
      WHERE l_returnflag = 'R') u
GROUP BY k""")
def op_union_pad(spark, sf_dir):
    """Union of two differently shaped inputs padded with typed zeros, then
    one re-aggregation."""
    t = OrderEntry(spark, sf_dir)
    zero = F.lit(0).cast("decimal(12,2)")
    a = t.li.filter(c("l_returnflag") != "R").select(c("l_orderkey").alias("k"), c("l_extendedprice").alias("sales"),
                                                     zero.alias("returns"))
    b = t.li.filter(c("l_returnflag") == "R").select(c("l_orderkey").alias("k"), zero.alias("sales"),
                                                     c("l_extendedprice").alias("returns"))
    return (union_all(a, b).groupBy(c("k").alias("orderkey"))
            .agg(F.sum("sales").cast("decimal(38,2)").alias("sales"),
                 F.sum("returns").cast("decimal(38,2)").alias("returns")))


@register("op_union_distinct", prelude="ops", sql="""
SELECT count(*) AS customers FROM (
  SELECT o_custkey FROM od WHERE year(o_orderdate) = $y1
  UNION SELECT o_custkey FROM od WHERE year(o_orderdate) = $y2) u""")
def op_union_distinct(spark, sf_dir, y1=1996, y2=1997):
    t = OrderEntry(spark, sf_dir)
    return union_distinct(_cust_in_year(t, y1), _cust_in_year(t, y2)).agg(F.count(F.lit(1)).alias("customers"))


@register("op_intersect", prelude="ops", sql="""
SELECT custkey FROM (
  SELECT o_custkey AS custkey FROM od WHERE year(o_orderdate) = $y1
  INTERSECT SELECT o_custkey FROM od WHERE year(o_orderdate) = $y1 + 1
  INTERSECT SELECT o_custkey FROM od WHERE year(o_orderdate) = $y1 + 2) x""")
def op_intersect(spark, sf_dir, y1=1996):
    t = OrderEntry(spark, sf_dir)
    return intersect(_cust_in_year(t, y1), _cust_in_year(t, y1 + 1), _cust_in_year(t, y1 + 2))


@register("op_except", prelude="ops", sql="""
SELECT custkey FROM (
  SELECT o_custkey AS custkey FROM od WHERE year(o_orderdate) = $y1
  EXCEPT SELECT o_custkey FROM od WHERE year(o_orderdate) = $y1 + 1
  EXCEPT SELECT o_custkey FROM od WHERE year(o_orderdate) = $y1 + 2) x""")
def op_except(spark, sf_dir, y1=1996):
    t = OrderEntry(spark, sf_dir)
    return except_(_cust_in_year(t, y1), _cust_in_year(t, y1 + 1), _cust_in_year(t, y1 + 2))
