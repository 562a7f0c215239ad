"""Subqueries and named results."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...functions.scalars import avg4, mean, r4
from ...operators.joins import attach_scalar
from ...operators.subqueries import above_group_avg, scalar
from ...sources.orderentry import OrderEntry
from ..registry import register

c = F.col


@register("op_scalar_subquery", prelude="ops", sql="""
SELECT o_orderpriority, count(*) AS n FROM od
WHERE o_totalprice > (SELECT avg(o_totalprice) FROM od)
GROUP BY o_orderpriority""")
def op_scalar_subquery(spark, sf_dir):
    """Uncorrelated scalar subquery: a keyless aggregate (one row) beside the rows."""
    t = OrderEntry(spark, sf_dir)
    a = scalar(t.od, mean("o_totalprice"), "avg_price")
    return (attach_scalar(t.od, a).filter(c("o_totalprice") > c("avg_price"))
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")))


_BANDS = [(1, 10), (11, 20), (21, 30), (31, 40), (41, 50)]


@register("op_scalar_case_merge", prelude="ops", sql="SELECT " + ",\n".join(
    f"""CASE WHEN (SELECT count(*) FROM li WHERE l_quantity BETWEEN {lo} AND {hi}) > $threshold
     THEN (SELECT round(CAST(sum(l_extendedprice) * 10000 AS DOUBLE) / count(l_extendedprice)) / 10000 FROM li WHERE l_quantity BETWEEN {lo} AND {hi})
     ELSE (SELECT round(CAST(sum(l_discount) * 10000 AS DOUBLE) / count(l_discount)) / 10000 FROM li WHERE l_quantity BETWEEN {lo} AND {hi}) END AS bucket{i + 1}"""
    for i, (lo, hi) in enumerate(_BANDS)))
def op_scalar_case_merge(spark, sf_dir, threshold=12000):
    """Fifteen scalar subqueries over one table, merged into one scan with
    conditional aggregates; the CASE then picks per band."""
    t = OrderEntry(spark, sf_dir)
    q = c("l_quantity")
    aggs = []
    for i, (lo, hi) in enumerate(_BANDS):
        inb = q.between(lo, hi)
        aggs += [F.count(F.when(inb, 1)).alias(f"n{i}"),
                 avg4(F.when(inb, c("l_extendedprice"))).alias(f"p{i}"),
                 avg4(F.when(inb, c("l_discount"))).alias(f"d{i}")]
    one = t.li.agg(*aggs)
    return one.select(*[F.when(c(f"n{i}") > threshold, c(f"p{i}")).otherwise(c(f"d{i}")).alias(f"bucket{i + 1}")
                        for i in range(len(_BANDS))])


@register("op_corr_avg", prelude="ops", sql="""
SELECT l_returnflag, count(*) AS n FROM li l1
WHERE l_quantity > 1.2 * (SELECT avg(l_quantity) FROM li l2 WHERE l2.l_partkey = l1.l_partkey)
GROUP BY l_returnflag""")
def op_corr_avg(spark, sf_dir):
    """Row against its group's average x factor: one aggregate by key joined back."""
    t = OrderEntry(spark, sf_dir)
    return (above_group_avg(t.li, "l_partkey", "l_quantity", 1.2)
            .groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")))


@register("op_corr_count", prelude="ops", sql="""
SELECT DISTINCT p1.p_type FROM pa p1
WHERE p1.p_size BETWEEN 10 AND 20
  AND (SELECT count(*) FROM pa p2 WHERE p2.p_type = p1.p_type
        AND ((p2.p_brand = 'Brand#1' AND p2.p_name LIKE 'blue%')
          OR (p2.p_brand = 'Brand#2' AND p2.p_size > 40))) > 0""")
def op_corr_count(spark, sf_dir):
    """Correlated ``count(*) > 0`` under OR: the qualifying keys are found once
    (distinct) and semi-joined."""
    t = OrderEntry(spark, sf_dir)
    q = t.pa.filter(((c("p_brand") == "Brand#1") & c("p_name").like("blue%"))
                    | ((c("p_brand") == "Brand#2") & (c("p_size") > 40))).select(c("p_type").alias("qt")).distinct()
    return (t.pa.filter(c("p_size").between(10, 20)).join(q, c("p_type") == c("qt"), "left_semi")
            .select("p_type").distinct())


@register("op_corr_rank_in", prelude="ops", sql="""
SELECT n_name, count(*) AS customers FROM cu JOIN nation ON c_nationkey = n_nationkey
WHERE n_name IN (SELECT n_name FROM (
    SELECT n_name, rank() OVER (ORDER BY sum(o_totalprice) DESC) AS rk
    FROM od JOIN cu ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name) x WHERE rk <= $k)
GROUP BY n_name""")
def op_corr_rank_in(spark, sf_dir, k=5):
    """IN over a ranked subquery: rank the (small) per-nation totals, keep the
    top k, semi-join."""
    t = OrderEntry(spark, sf_dir)
    per = (t.od.join(t.cu, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey"))
           .groupBy(c("n_name").alias("top_name")).agg(F.sum("o_totalprice").alias("total")))
    from ...operators.windows import global_rank_top
    top = global_rank_top(per, ["total"], [True], k)
    j = t.cu.join(t.nation, c("c_nationkey") == c("n_nationkey")).join(top, c("n_name") == c("top_name"), "left_semi")
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@register("op_cte", prelude="ops", sql="""
, cy AS (SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS total FROM od
         GROUP BY o_custkey, year(o_orderdate))
SELECT a.yr, count(*) AS growing, round(CAST(avg(b.total / a.total) AS DOUBLE), 4) AS avg_growth,
       (SELECT count(*) FROM cy) AS customer_years
FROM cy a JOIN cy b ON a.k = b.k AND b.yr = a.yr + 1
WHERE b.total > a.total
GROUP BY a.yr""")
def op_cte(spark, sf_dir):
    """A named result used three times.  Spark reuses the identical
    aggregate's exchange within the plan (ReuseExchange), so the CTE is
    computed once without pinning it in executor memory."""
    t = OrderEntry(spark, sf_dir)
    cy = (t.od.groupBy(c("o_custkey").alias("k"), F.year("o_orderdate").alias("yr"))
          .agg(F.sum("o_totalprice").alias("total")))
    b = cy.select(c("k").alias("bk"), c("yr").alias("byr"), c("total").alias("btotal"))
    j = cy.join(b, (c("k") == c("bk")) & (c("byr") == c("yr") + 1)).filter(c("btotal") > c("total"))
    n = cy.agg(F.count(F.lit(1)).alias("customer_years"))
    g = j.groupBy("yr").agg(F.count(F.lit(1)).alias("growing"), r4(mean(c("btotal") / c("total"))).alias("avg_growth"))
    return attach_scalar(g, n)


@register("op_derived", prelude="ops", sql="""
SELECT size_class, count(*) AS orders, round(CAST(sum(lines) * 10000 AS DOUBLE) / count(lines)) / 10000 AS avg_lines FROM (
  SELECT o_orderkey, lines, CASE WHEN qty > 100 THEN 'big' ELSE 'small' END AS size_class FROM (
    SELECT l_orderkey AS o_orderkey, count(*) AS lines, sum(l_quantity) AS qty FROM li GROUP BY l_orderkey) a) b
GROUP BY size_class""")
def op_derived(spark, sf_dir):
    """Derived tables nested three deep (each a DataFrame variable)."""
    t = OrderEntry(spark, sf_dir)
    a = t.li.groupBy(c("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("lines"),
                                                              F.sum("l_quantity").alias("qty"))
    b = a.select("o_orderkey", "lines", F.when(c("qty") > 100, "big").otherwise("small").alias("size_class"))
    return b.groupBy("size_class").agg(F.count(F.lit(1)).alias("orders"), avg4("lines").alias("avg_lines"))
