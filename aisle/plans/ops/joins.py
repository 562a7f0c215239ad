"""Joins, semi / anti joins and subquery joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import avg4, mean, money_sum, quotient4
from ...operators import joins as J
from ...operators.subqueries import scalar
from ...sources.orderentry import OrderEntry
from ..registry import register

c = F.col


def _rev():
    return (c("l_extendedprice") * (1 - c("l_discount"))).cast("decimal(16,4)")


@register("op_join_inner_equi", prelude="ops", sql="""
SELECT r_name, CAST(year(o_orderdate) AS INTEGER) AS o_year,
       CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(16,4))) AS DECIMAL(38,4)) AS revenue
FROM li, od, cu, nation, region
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey
  AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey
GROUP BY r_name, year(o_orderdate)""")
def op_join_inner_equi(spark, sf_dir):
    """Five-relation star join; Catalyst orders it, AQE broadcasts the tiny
    nation/region sides by their measured size."""
    t = OrderEntry(spark, sf_dir)
    j = (t.li.join(t.od, c("l_orderkey") == c("o_orderkey"))
         .join(t.cu, c("o_custkey") == c("c_custkey"))
         .join(t.nation, c("c_nationkey") == c("n_nationkey"))
         .join(t.region, c("n_regionkey") == c("r_regionkey")))
    return (j.groupBy("r_name", F.year("o_orderdate").alias("o_year"))
            .agg(F.sum(_rev()).cast("decimal(38,4)").alias("revenue")))


@register("op_join_explicit", prelude="ops", sql="""
SELECT n_name, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty
FROM li JOIN su ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
GROUP BY n_name""")
def op_join_explicit(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    j = t.li.join(t.su, c("l_suppkey") == c("s_suppkey")).join(t.nation, c("s_nationkey") == c("n_nationkey"))
    return j.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"))


@register("op_join_multi_key", prelude="ops", sql="""
SELECT li.l_returnflag, count(*) AS n
FROM li JOIN (SELECT l_orderkey AS k1, l_partkey AS k2, count(*) AS cnt FROM li
              GROUP BY l_orderkey, l_partkey) g
  ON li.l_orderkey = g.k1 AND li.l_partkey = g.k2
WHERE g.cnt > 1
GROUP BY li.l_returnflag""")
def op_join_multi_key(spark, sf_dir):
    """Lines whose (order, part) pair occurs more than once: join on both keys."""
    t = OrderEntry(spark, sf_dir)
    g = (t.li.groupBy(c("l_orderkey").alias("k1"), c("l_partkey").alias("k2"))
         .agg(F.count(F.lit(1)).alias("cnt")).filter(c("cnt") > 1))
    j = t.li.join(g, (c("l_orderkey") == g.k1) & (c("l_partkey") == g.k2))
    return j.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("op_join_broadcast_dim", prelude="ops", sql="""
SELECT p_type, n_name, count(*) AS n, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue
FROM li JOIN pa ON l_partkey = p_partkey JOIN su ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
GROUP BY p_type, n_name""")
def op_join_broadcast_dim(spark, sf_dir):
    """Fact to dimensions.  None is broadcast by hint: the planner broadcasts
    a side only when its measured size is under the threshold and keeps a
    shuffle join otherwise."""
    t = OrderEntry(spark, sf_dir)
    j = (t.li.join(t.pa, c("l_partkey") == c("p_partkey"))
         .join(t.su, c("l_suppkey") == c("s_suppkey"))
         .join(t.nation, c("s_nationkey") == c("n_nationkey")))
    return j.groupBy("p_type", "n_name").agg(F.count(F.lit(1)).alias("n"),
                                             money_sum("l_extendedprice").alias("revenue"))


@register("op_join_left", prelude="ops", sql="""
SELECT o_orderstatus, count(*) AS orders, CAST(sum(coalesce(r.n_ret, 0)) AS BIGINT) AS returned_lines,
       count(r.k) AS orders_with_returns
FROM od LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n_ret FROM li WHERE l_returnflag = 'R'
                   GROUP BY l_orderkey) r ON o_orderkey = r.k
GROUP BY o_orderstatus""")
def op_join_left(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    r = (t.li.filter(c("l_returnflag") == "R").groupBy(c("l_orderkey").alias("k"))
         .agg(F.count(F.lit(1)).alias("n_ret")))
    j = t.od.join(r, c("o_orderkey") == r.k, "left")
    return j.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.coalesce(c("n_ret"), F.lit(0))).cast("bigint").alias("returned_lines"),
        F.count("k").alias("orders_with_returns"))


@register("op_join_left_to_inner", prelude="ops", sql="""
SELECT o_orderpriority, count(*) AS n
FROM od LEFT JOIN li ON o_orderkey = l_orderkey
WHERE l_returnflag = 'R'
GROUP BY o_orderpriority""")
def op_join_left_to_inner(spark, sf_dir):
    """Left join cancelled by a filter on the right side: Catalyst turns it
    into an inner join (EliminateOuterJoin) and pushes the filter down."""
    t = OrderEntry(spark, sf_dir)
    return (t.od.join(t.li, c("o_orderkey") == c("l_orderkey"), "left")
            .filter(c("l_returnflag") == "R")
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")))


@register("op_join_anti_isnull", prelude="ops", sql="""
SELECT c_mktsegment, count(*) AS n
FROM cu LEFT JOIN (SELECT DISTINCT o_custkey FROM od WHERE year(o_orderdate) = $year) y
  ON c_custkey = y.o_custkey
WHERE y.o_custkey IS NULL
GROUP BY c_mktsegment""")
def op_join_anti_isnull(spark, sf_dir, year=1998):
    """``LEFT JOIN .. WHERE right.key IS NULL`` written as a left-anti join."""
    t = OrderEntry(spark, sf_dir)
    y = t.od.filter(F.year("o_orderdate") == year)
    return (J.not_exists(t.cu, y, ["c_custkey"], ["o_custkey"])
            .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")))


@register("op_join_full", prelude="ops", sql="""
SELECT CASE WHEN a.k IS NULL THEN 'second only' WHEN b.k IS NULL THEN 'first only' ELSE 'both' END AS side,
       count(*) AS customers,
       CAST(sum(coalesce(a.v, 0)) AS DECIMAL(38,2)) AS first_total,
       CAST(sum(coalesce(b.v, 0)) AS DECIMAL(38,2)) AS second_total
FROM (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM od WHERE year(o_orderdate) = $y1 GROUP BY o_custkey) a
FULL OUTER JOIN
     (SELECT o_custkey AS k, sum(o_totalprice) AS v FROM od WHERE year(o_orderdate) = $y2 GROUP BY o_custkey) b
  ON a.k = b.k
GROUP BY 1""")
def op_join_full(spark, sf_dir, y1=1996, y2=1997):
    t = OrderEntry(spark, sf_dir)

    def tot(y, n):
        return (t.od.filter(F.year("o_orderdate") == y).groupBy(c("o_custkey").alias("k"))
                .agg(F.sum("o_totalprice").alias(n)))
    j = J.full_coalesce(tot(y1, "v1"), tot(y2, "v2"), ["k"])
    side = (F.when(c("v1").isNull(), "second only").when(c("v2").isNull(), "first only")
            .otherwise("both"))
    return (j.groupBy(side.alias("side"))
            .agg(F.count(F.lit(1)).alias("customers"),
                 F.sum(F.coalesce(c("v1"), F.lit(0))).cast("decimal(38,2)").alias("first_total"),
                 F.sum(F.coalesce(c("v2"), F.lit(0))).cast("decimal(38,2)").alias("second_total")))


@register("op_join_cross_scalar", prelude="ops", sql="""
SELECT * FROM
 (SELECT count(*) AS small_lines FROM li WHERE l_quantity < 10) a,
 (SELECT round(CAST(sum(l_extendedprice) * 10000 AS DOUBLE) / count(l_extendedprice)) / 10000 AS big_avg_price FROM li WHERE l_quantity > 40) b,
 (SELECT count(DISTINCT l_suppkey) AS returned_suppliers FROM li WHERE l_returnflag = 'R') c""")
def op_join_cross_scalar(spark, sf_dir):
    """One-row results side by side.  The three scalar subqueries read the
    same table with different filters; instead of three scans joined by a
    cartesian product, one pass with conditional aggregates gives the row."""
    t = OrderEntry(spark, sf_dir)
    return t.li.agg(
        F.count(F.when(c("l_quantity") < 10, 1)).alias("small_lines"),
        avg4(F.when(c("l_quantity") > 40, c("l_extendedprice"))).alias("big_avg_price"),
        F.count_distinct(F.when(c("l_returnflag") == "R", c("l_suppkey"))).alias("returned_suppliers"))


@register("op_join_cross_broadcast", prelude="ops", sql="""
SELECT n_name, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
       round(CAST(sum(l_extendedprice) * 100000000 AS DOUBLE) / CAST(max(t.total) * 100 AS DOUBLE)) / 10000 AS pct
FROM li JOIN su ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey,
     (SELECT sum(l_extendedprice) AS total FROM li) t
GROUP BY n_name""")
def op_join_cross_broadcast(spark, sf_dir):
    """Many rows beside one row: the grand total is a keyless aggregate
    (exactly one row), broadcast next to the per-nation totals."""
    t = OrderEntry(spark, sf_dir)
    per = (t.li.join(t.su, c("l_suppkey") == c("s_suppkey"))
           .join(t.nation, c("s_nationkey") == c("n_nationkey"))
           .groupBy("n_name").agg(F.sum("l_extendedprice").alias("rev")))
    total = scalar(t.li, F.sum("l_extendedprice"), "total")
    return (J.attach_scalar(per, total)
            .select("n_name", c("rev").cast("decimal(38,2)").alias("revenue"),
                    quotient4(c("rev") * 100, "total").alias("pct")))


@register("op_join_self", prelude="ops", sql="""
SELECT cn.n_name AS customer_nation,
       count(*) AS lines,
       count(CASE WHEN sn.n_regionkey = cn.n_regionkey THEN 1 END) AS same_region_lines
FROM li JOIN od ON l_orderkey = o_orderkey JOIN cu ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN su ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
GROUP BY cn.n_name""")
def op_join_self(spark, sf_dir):
    """``nation`` in two roles (customer's and supplier's) via aliases."""
    t = OrderEntry(spark, sf_dir)
    cn = t.nation.select(c("n_nationkey").alias("cn_key"), c("n_name").alias("customer_nation"),
                         c("n_regionkey").alias("cn_region"))
    sn = t.nation.select(c("n_nationkey").alias("sn_key"), c("n_regionkey").alias("sn_region"))
    j = (t.li.join(t.od, c("l_orderkey") == c("o_orderkey"))
         .join(t.cu, c("o_custkey") == c("c_custkey"))
         .join(cn, c("c_nationkey") == c("cn_key"))
         .join(t.su, c("l_suppkey") == c("s_suppkey"))
         .join(sn, c("s_nationkey") == c("sn_key")))
    return j.groupBy("customer_nation").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(F.when(c("sn_region") == c("cn_region"), 1)).alias("same_region_lines"))


@register("op_join_self_offset", prelude="ops", sql="""
, y AS (SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS yr, sum(o_totalprice) AS total
           FROM od JOIN cu ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           GROUP BY n_name, year(o_orderdate))
SELECT a.n_name, a.yr, CAST(a.total AS DECIMAL(38,2)) AS total, CAST(b.total AS DECIMAL(38,2)) AS next_total,
       round(CAST(b.total * 1000000 AS DOUBLE) / CAST(NULLIF(a.total, 0) * 100 AS DOUBLE)) / 10000 AS growth
FROM y a JOIN y b ON a.n_name = b.n_name AND a.yr + 1 = b.yr""")
def op_join_self_offset(spark, sf_dir):
    """Self-join on key + 1 (this year against next year)."""
    t = OrderEntry(spark, sf_dir)
    y = (t.od.join(t.cu, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey"))
         .groupBy("n_name", F.year("o_orderdate").alias("yr")).agg(F.sum("o_totalprice").alias("total")))
    b = y.select(c("n_name").alias("b_name"), c("yr").alias("b_yr"), c("total").alias("b_total"))
    j = y.join(b, (c("n_name") == c("b_name")) & (c("yr") + 1 == c("b_yr")))
    return j.select("n_name", "yr", c("total").cast("decimal(38,2)").alias("total"),
                    c("b_total").cast("decimal(38,2)").alias("next_total"),
                    quotient4("b_total", "total").alias("growth"))


@register("op_join_self_versions", prelude="ops", sql="""
, y AS (SELECT o_custkey AS k, year(o_orderdate) AS yr, sum(o_totalprice) AS total
           FROM od WHERE year(o_orderdate) IN ($y1, $y1 + 1, $y1 + 2) GROUP BY o_custkey, year(o_orderdate))
SELECT a.k AS custkey, CAST(a.total AS DECIMAL(38,2)) AS t1, CAST(b.total AS DECIMAL(38,2)) AS t2,
       CAST(c.total AS DECIMAL(38,2)) AS t3
FROM y a JOIN y b ON a.k = b.k JOIN y c ON a.k = c.k
WHERE a.yr = $y1 AND b.yr = $y1 + 1 AND c.yr = $y1 + 2 AND b.total > a.total AND c.total > b.total""")
def op_join_self_versions(spark, sf_dir, y1=1996):
    """One aggregate, filtered into per-year versions, self-joined on customer.
    The aggregate is computed once and reused by all three branches
    (Spark reuses the identical exchange)."""
    t = OrderEntry(spark, sf_dir)
    y = (t.od.filter(F.year("o_orderdate").isin(y1, y1 + 1, y1 + 2))
         .groupBy(c("o_custkey").alias("k"), F.year("o_orderdate").alias("yr"))
         .agg(F.sum("o_totalprice").alias("total")))

    def ver(i, n):
        return y.filter(c("yr") == y1 + i).select(c("k").alias(f"k{n}"), c("total").alias(n))
    a, b, d = ver(0, "t1"), ver(1, "t2"), ver(2, "t3")
    j = a.join(b, c("kt1") == c("kt2")).join(d, c("kt1") == c("kt3"))
    return (j.filter((c("t2") > c("t1")) & (c("t3") > c("t2")))
            .select(c("kt1").alias("custkey"), *[c(n).cast("decimal(38,2)").alias(n) for n in ("t1", "t2", "t3")]))


@register("op_join_computed_key", prelude="ops", sql="""
SELECT r_name, count(*) AS customers
FROM cu JOIN nation ON upper(concat('nation_', CAST(c_nationkey AS VARCHAR))) = upper(n_name)
JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name""")
def op_join_computed_key(spark, sf_dir):
    """Equi-join on expressions of both sides (``upper`` of a built name)."""
    t = OrderEntry(spark, sf_dir)
    key = F.upper(F.concat(F.lit("nation_"), c("c_nationkey").cast("string")))
    j = (t.cu.join(t.nation, key == F.upper(c("n_name")))
         .join(t.region, c("n_regionkey") == c("r_regionkey")))
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("customers"))


@register("op_join_theta_residual", prelude="ops", sql="""
SELECT o_orderpriority, count(*) AS late_lines
FROM li JOIN od ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate + $days
GROUP BY o_orderpriority""")
def op_join_theta_residual(spark, sf_dir, days=30):
    """Equi-join plus an inequality: the equality drives the (hash or sort
    merge) join, the inequality is a residual condition on matched pairs."""
    t = OrderEntry(spark, sf_dir)
    j = t.li.join(t.od, (c("l_orderkey") == c("o_orderkey"))
                  & (c("l_shipdate") > F.date_add(c("o_orderdate"), days)))
    return j.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("late_lines"))


@register("op_join_disjunctive", prelude="ops", sql="""
SELECT CAST(sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(16,4))) AS DECIMAL(38,4)) AS revenue,
       count(*) AS n
FROM li, pa
WHERE (p_partkey = l_partkey AND p_brand = '$b1' AND l_quantity BETWEEN 1 AND 11 AND p_size BETWEEN 1 AND 5)
   OR (p_partkey = l_partkey AND p_brand = '$b2' AND l_quantity BETWEEN 10 AND 20 AND p_size BETWEEN 1 AND 10)
   OR (p_partkey = l_partkey AND p_brand = '$b3' AND l_quantity BETWEEN 20 AND 30 AND p_size BETWEEN 1 AND 15)""")
def op_join_disjunctive(spark, sf_dir, b1="Brand#12", b2="Brand#23", b3="Brand#4"):
    """OR of branches that share the join key: the key is factored out as the
    equi-join condition and the OR stays as a residual (no cartesian join)."""
    t = OrderEntry(spark, sf_dir)
    q, s, br = c("l_quantity"), c("p_size"), c("p_brand")
    resid = (((br == b1) & q.between(1, 11) & s.between(1, 5))
             | ((br == b2) & q.between(10, 20) & s.between(1, 10))
             | ((br == b3) & q.between(20, 30) & s.between(1, 15)))
    j = t.li.join(t.pa, (c("p_partkey") == c("l_partkey")) & resid)
    return j.agg(F.sum(_rev()).cast("decimal(38,4)").alias("revenue"), F.count(F.lit(1)).alias("n"))


@register("op_join_range_scalar", prelude="ops", sql="""
SELECT o_orderpriority, count(*) AS n
FROM od
WHERE o_totalprice BETWEEN (SELECT avg(o_totalprice) * 0.9 FROM od)
                       AND (SELECT avg(o_totalprice) * 1.1 FROM od)
GROUP BY o_orderpriority""")
def op_join_range_scalar(spark, sf_dir):
    """Key between two scalar bounds: one keyless aggregate (one row),
    broadcast beside the rows, then a range filter."""
    t = OrderEntry(spark, sf_dir)
    b = t.od.agg((mean("o_totalprice") * F.lit(0.9).cast("decimal(2,1)")).alias("lo"),
                 (mean("o_totalprice") * F.lit(1.1).cast("decimal(2,1)")).alias("hi"))
    return (J.attach_scalar(t.od, b).filter(c("o_totalprice").between(c("lo"), c("hi")))
            .groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")))


@register("op_semi_exists", prelude="ops", sql="""
SELECT c_mktsegment, count(*) AS n FROM cu
WHERE EXISTS (SELECT 1 FROM od WHERE o_custkey = c_custkey AND year(o_orderdate) = $year)
GROUP BY c_mktsegment""")
def op_semi_exists(spark, sf_dir, year=1997):
    t = OrderEntry(spark, sf_dir)
    o = t.od.filter(F.year("o_orderdate") == year)
    return (t.cu.join(o, c("c_custkey") == c("o_custkey"), "left_semi")
            .groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n")))


@register("op_semi_theta", prelude="ops", sql="""
SELECT l1.l_returnflag, count(*) AS n FROM li l1
WHERE EXISTS (SELECT 1 FROM li l2 WHERE l2.l_orderkey = l1.l_orderkey AND l2.l_suppkey <> l1.l_suppkey)
GROUP BY l1.l_returnflag""")
def op_semi_theta(spark, sf_dir):
    """EXISTS (same order, other supplier).  Per order only the smallest and
    largest supplier are needed, so the semi join sees one row per order
    instead of comparing all line pairs of an order."""
    t = OrderEntry(spark, sf_dir)
    return (J.semi_other(t.li, t.li, "l_orderkey", "l_suppkey", "l_orderkey", "l_suppkey")
            .groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")))


@register("op_anti_not_exists", prelude="ops", sql="""
SELECT o_orderstatus, count(*) AS n FROM od
WHERE NOT EXISTS (SELECT 1 FROM li WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')
GROUP BY o_orderstatus""")
def op_anti_not_exists(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    r = t.li.filter(c("l_returnflag") == "R")
    return (J.not_exists(t.od, r, ["o_orderkey"], ["l_orderkey"])
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@register("op_exists_or", prelude="ops", sql="""
SELECT c_mktsegment, count(*) AS n FROM cu
WHERE EXISTS (SELECT 1 FROM od WHERE o_custkey = c_custkey AND year(o_orderdate) = $year)
  AND (EXISTS (SELECT 1 FROM od WHERE o_custkey = c_custkey AND year(o_orderdate) = $year + 1
               AND o_orderpriority = '1-URGENT')
    OR EXISTS (SELECT 1 FROM od WHERE o_custkey = c_custkey AND year(o_orderdate) = $year + 2
               AND o_orderpriority = '2-HIGH'))
GROUP BY c_mktsegment""")
def op_exists_or(spark, sf_dir, year=1996):
    t = OrderEntry(spark, sf_dir)
    yr = F.year("o_orderdate")
    must = t.od.filter(yr == year)
    e1 = t.od.filter((yr == year + 1) & (c("o_orderpriority") == "1-URGENT"))
    e2 = t.od.filter((yr == year + 2) & (c("o_orderpriority") == "2-HIGH"))
    out = J.exists_flags(t.cu, ["c_custkey"], must, ["o_custkey"],
                         [(e1, ["o_custkey"]), (e2, ["o_custkey"])])
    return out.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))


@register("op_in_subquery", prelude="ops", sql="""
SELECT l_returnflag, count(*) AS n FROM li
WHERE l_partkey IN (SELECT p_partkey FROM pa WHERE p_size IN (1, 2, 3, 4, 5))
  AND l_suppkey IN (SELECT s_suppkey FROM su WHERE s_nationkey IN
                      (SELECT n_nationkey FROM nation WHERE n_regionkey = $region))
GROUP BY l_returnflag""")
def op_in_subquery(spark, sf_dir, region=1):
    """Nested IN subqueries as left-semi joins."""
    t = OrderEntry(spark, sf_dir)
    pa = t.pa.filter(c("p_size").isin(1, 2, 3, 4, 5))
    na = t.nation.filter(c("n_regionkey") == region)
    su = t.su.join(na, c("s_nationkey") == c("n_nationkey"), "left_semi")
    out = (t.li.join(pa, c("l_partkey") == c("p_partkey"), "left_semi")
           .join(su, c("l_suppkey") == c("s_suppkey"), "left_semi"))
    return out.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@register("op_in_or", prelude="ops", sql="""
SELECT l_linestatus, count(*) AS n FROM li
WHERE l_returnflag = 'R' OR l_partkey IN (SELECT p_partkey FROM pa WHERE p_size > $size)
GROUP BY l_linestatus""")
def op_in_or(spark, sf_dir, size=45):
    """IN subquery under OR: an existence flag from a join on distinct keys,
    then the OR as a plain filter."""
    t = OrderEntry(spark, sf_dir)
    big = t.pa.filter(c("p_size") > size)
    out = J.with_flag(t.li, big, ["l_partkey"], ["p_partkey"], "big_part")
    return (out.filter((c("l_returnflag") == "R") | c("big_part"))
            .groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n")))
