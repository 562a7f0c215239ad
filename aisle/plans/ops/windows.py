"""Window functions and sorts / limits (2.6)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...functions.scalars import avg4_over, mean_over
from ...operators.aggs import rollup_levels
from ...operators.sorts import asc, desc, order, topk
from ...operators.windows import global_rank_top, prev_next, rank_in_groups, running, share_of, topk_per_group
from ...sources.orderentry import OrderEntry
from ..registry import register

c = F.col


def _brand_rev(t):
    j = t.li.join(t.pa, c("l_partkey") == c("p_partkey"))
    return j.groupBy("p_type", "p_brand").agg(F.sum("l_extendedprice").alias("rev"))


@register("op_win_share", prelude="ops", sql="""
SELECT p_type, p_brand, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
       round(CAST(sum(l_extendedprice) * 100000000 AS DOUBLE) / CAST(sum(sum(l_extendedprice)) OVER (PARTITION BY p_type) * 100 AS DOUBLE)) / 10000 AS share
FROM li JOIN pa ON l_partkey = p_partkey GROUP BY p_type, p_brand""")
def op_win_share(spark, sf_dir):
    """Aggregate first, then the partition total as a window over the
    (small) aggregate: the window shuffles groups, not lines."""
    t = OrderEntry(spark, sf_dir)
    g = _brand_rev(t)
    return g.select("p_type", "p_brand", c("rev").cast("decimal(38,2)").alias("revenue"),
                    share_of("rev", ["p_type"]).alias("share"))


_MONTHLY = """WITH m AS (SELECT n_name, CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mo,
           sum(o_totalprice) AS total
           FROM od JOIN cu ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
           GROUP BY n_name, year(o_orderdate), month(o_orderdate))
"""


def _monthly(t):
    j = t.od.join(t.cu, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey"))
    return j.groupBy("n_name", F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mo")).agg(
        F.sum("o_totalprice").alias("total"))


@register("op_win_avg_part", prelude="ops", sql=_MONTHLY.replace("WITH", ", ", 1) + """
SELECT n_name, yr, mo, CAST(total AS DECIMAL(38,2)) AS total, avg4 AS avg_total
FROM (SELECT *, avg(total) OVER w AS avg_total, round(CAST(sum(total) OVER w * 10000 AS DOUBLE) / count(total) OVER w) / 10000 AS avg4
      FROM m WINDOW w AS (PARTITION BY n_name, yr)) x
WHERE abs(total - avg_total) / avg_total > 0.1""")
def op_win_avg_part(spark, sf_dir):
    """Group value against its partition average (months deviating > 10%)."""
    t = OrderEntry(spark, sf_dir)
    w = Window.partitionBy("n_name", "yr")
    m = _monthly(t).withColumn("avg_total", mean_over("total", w)).withColumn("avg4", avg4_over("total", w))
    return (m.filter(F.abs(c("total") - c("avg_total")) / c("avg_total") > 0.1)
            .select("n_name", "yr", "mo", c("total").cast("decimal(38,2)").alias("total"),
                    c("avg4").alias("avg_total")))


@register("op_win_rank_part", prelude="ops", sql="""
SELECT p_type, p_brand, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
       rank() OVER (PARTITION BY p_type ORDER BY sum(l_extendedprice) DESC) AS rk
FROM li JOIN pa ON l_partkey = p_partkey GROUP BY p_type, p_brand""")
def op_win_rank_part(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    g = _brand_rev(t)
    w = Window.partitionBy("p_type").orderBy(desc("rev"))
    return g.select("p_type", "p_brand", c("rev").cast("decimal(38,2)").alias("revenue"),
                    F.rank().over(w).cast("long").alias("rk"))


@register("op_win_rank_global", prelude="ops", sql="""
SELECT * FROM (
  SELECT l_suppkey, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
         rank() OVER (ORDER BY sum(l_extendedprice) DESC) AS rnk
  FROM li GROUP BY l_suppkey) x
WHERE rnk <= $k""")
def op_win_rank_global(spark, sf_dir, k=10):
    """Global rank, best ``k``.  No single-task window over every supplier:
    a bounded top-k picks the candidates, the rank runs on those."""
    t = OrderEntry(spark, sf_dir)
    g = t.li.groupBy("l_suppkey").agg(F.sum("l_extendedprice").cast("decimal(38,2)").alias("revenue"))
    return global_rank_top(g, ["revenue"], [True], k)


@register("op_win_rank_all", prelude="ops", sql="""
SELECT 'supplier' AS kind, l_suppkey AS id, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
       rank() OVER (ORDER BY sum(l_extendedprice)) AS rnk
FROM li GROUP BY l_suppkey
UNION ALL
SELECT 'item', l_partkey, CAST(sum(l_quantity) AS DECIMAL(38,2)), rank() OVER (ORDER BY sum(l_quantity))
FROM li GROUP BY l_partkey""")
def op_win_rank_all(spark, sf_dir):
    """Global rank of every supplier by revenue and of every item by quantity
    (many ties), with no task over all of them."""
    t = OrderEntry(spark, sf_dir)

    def totals(kind, key, value):
        return t.li.groupBy(c(key).alias("id")).agg(F.sum(value).cast("decimal(38,2)").alias("revenue")) \
            .select(F.lit(kind).alias("kind"), "id", "revenue")
    u = totals("supplier", "l_suppkey", "l_extendedprice").unionByName(totals("item", "l_partkey", "l_quantity"))
    return rank_in_groups(u, ["kind"], "revenue")


@register("op_win_rank_rollup", prelude="ops", sql="""
SELECT p_type, p_brand, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
       CAST(grouping(p_type) + grouping(p_brand) AS INT) AS lochierarchy,
       rank() OVER (PARTITION BY grouping(p_type) + grouping(p_brand),
                    CASE WHEN grouping(p_brand) = 0 THEN p_type END
                    ORDER BY sum(l_extendedprice) DESC) AS rank_within_parent
FROM li JOIN pa ON l_partkey = p_partkey
GROUP BY ROLLUP (p_type, p_brand)""")
def op_win_rank_rollup(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    g = _brand_rev(t)
    r = rollup_levels(g, ["p_type", "p_brand"], [F.sum("rev").alias("rev")])
    w = Window.partitionBy("lochierarchy", F.when(c("g_p_brand") == 0, c("p_type"))).orderBy(desc("rev"))
    return r.select("p_type", "p_brand", c("rev").cast("decimal(38,2)").alias("revenue"),
                    c("lochierarchy").cast("int").alias("lochierarchy"),
                    F.rank().over(w).cast("long").alias("rank_within_parent"))


_DAILY = """WITH d AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderdate AS dt, sum(o_totalprice) AS total
           FROM od GROUP BY year(o_orderdate), o_orderdate)
"""


def _daily(t):
    return t.od.groupBy(F.year("o_orderdate").alias("yr"), c("o_orderdate").alias("dt")).agg(
        F.sum("o_totalprice").alias("total"))


@register("op_win_running_sum", prelude="ops", sql=_DAILY.replace("WITH", ", ", 1) + """
SELECT yr, dt, CAST(total AS DECIMAL(38,2)) AS total,
       CAST(sum(total) OVER (PARTITION BY yr ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38,2)) AS cum_total
FROM d""")
def op_win_running_sum(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    d = _daily(t)
    return d.select("yr", "dt", c("total").cast("decimal(38,2)").alias("total"),
                    running(F.sum, "total", ["yr"], ["dt"]).cast("decimal(38,2)").alias("cum_total"))


@register("op_win_running_max", prelude="ops", sql=_DAILY.replace("WITH", ", ", 1) + """
SELECT yr, dt, CAST(total AS DECIMAL(38,2)) AS total,
       CAST(max(total) OVER (PARTITION BY yr ORDER BY dt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DECIMAL(38,2)) AS running_max
FROM d""")
def op_win_running_max(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    d = _daily(t)
    return d.select("yr", "dt", c("total").cast("decimal(38,2)").alias("total"),
                    running(F.max, "total", ["yr"], ["dt"]).cast("decimal(38,2)").alias("running_max"))


@register("op_win_prev_next", prelude="ops", sql=_MONTHLY.replace("WITH", ", ", 1) + """
, r AS (SELECT *, rank() OVER (PARTITION BY n_name ORDER BY yr, mo) AS rn FROM m)
SELECT a.n_name, a.yr, a.mo, CAST(a.total AS DECIMAL(38,2)) AS total,
       CAST(p.total AS DECIMAL(38,2)) AS prev_total, CAST(n.total AS DECIMAL(38,2)) AS next_total
FROM r a LEFT JOIN r p ON a.n_name = p.n_name AND a.rn = p.rn + 1
         LEFT JOIN r n ON a.n_name = n.n_name AND a.rn = n.rn - 1""")
def op_win_prev_next(spark, sf_dir):
    """Previous / next period.  The suite writes a self-join on rank +- 1; with
    a unique order key that is exactly ``lag``/``lead`` over one window, which
    needs one shuffle instead of three."""
    t = OrderEntry(spark, sf_dir)
    m = prev_next(_monthly(t), ["n_name"], ["yr", "mo"], "total", "prev_total", "next_total")
    return m.select("n_name", "yr", "mo", *[c(x).cast("decimal(38,2)").alias(x)
                                            for x in ("total", "prev_total", "next_total")])


@register("op_win_topk_per_group", prelude="ops", sql="""
SELECT * FROM (
  SELECT p_type, p_partkey, CAST(sum(l_extendedprice) AS DECIMAL(38,2)) AS revenue,
         rank() OVER (PARTITION BY p_type ORDER BY sum(l_extendedprice) DESC) AS rk
  FROM li JOIN pa ON l_partkey = p_partkey GROUP BY p_type, p_partkey) x
WHERE rk <= $k""")
def op_win_topk_per_group(spark, sf_dir, k=3):
    t = OrderEntry(spark, sf_dir)
    g = (t.li.join(t.pa, c("l_partkey") == c("p_partkey")).groupBy("p_type", "p_partkey")
         .agg(F.sum("l_extendedprice").cast("decimal(38,2)").alias("revenue")))
    return topk_per_group(g, ["p_type"], [desc("revenue")], k)


# ---- sorts -----------------------------------------------------------------
def _cust_rev(t):
    j = t.od.join(t.cu, c("o_custkey") == c("c_custkey")).join(t.nation, c("c_nationkey") == c("n_nationkey"))
    return j.groupBy("n_name", "c_custkey").agg(F.sum("o_totalprice").cast("decimal(38,2)").alias("revenue"),
                                                F.count(F.lit(1)).alias("n"))


_CUST = """WITH cr AS (SELECT n_name, c_custkey, CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS revenue, count(*) AS n
            FROM od JOIN cu ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
            GROUP BY n_name, c_custkey)
"""


@register("op_sort_mixed", prelude="ops", sql=_CUST.replace("WITH", ", ", 1) + """
SELECT * FROM cr ORDER BY n_name ASC NULLS LAST, revenue DESC NULLS FIRST, c_custkey, n LIMIT 100""")
def op_sort_mixed(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return topk(_cust_rev(t), ["n_name", "-revenue", "c_custkey"])


@register("op_sort_nulls", prelude="ops", sql="""
, x AS (SELECT c_custkey, c_mktsegment, max(o_totalprice) AS best
        FROM cu LEFT JOIN od ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
                              AND year(o_orderdate) = $year
        GROUP BY c_custkey, c_mktsegment)
SELECT * FROM x ORDER BY best DESC NULLS FIRST, c_custkey ASC NULLS LAST, c_mktsegment LIMIT 100""")
def op_sort_nulls(spark, sf_dir, year=1997):
    """NULL sorts as the largest value: first when descending."""
    t = OrderEntry(spark, sf_dir)
    o = t.od.filter((c("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == year))
    x = (t.cu.join(o, c("c_custkey") == c("o_custkey"), "left")
         .groupBy("c_custkey", "c_mktsegment").agg(F.max("o_totalprice").alias("best")))
    return topk(x, ["-best", "c_custkey"])


@register("op_sort_ordinal", prelude="ops", sql=_CUST.replace("WITH", ", ", 1) + """
SELECT n_name, revenue, c_custkey, n FROM cr ORDER BY 2 DESC NULLS FIRST, 1, 3, 4 LIMIT 100""")
def op_sort_ordinal(spark, sf_dir):
    """ORDER BY position: written with the column names."""
    t = OrderEntry(spark, sf_dir)
    x = _cust_rev(t).select("n_name", "revenue", "c_custkey", "n")
    return topk(x, ["-revenue", "n_name", "c_custkey", "n"])


@register("op_sort_expr", prelude="ops", sql=_CUST.replace("WITH", ", ", 1) + """
SELECT * FROM cr ORDER BY revenue / n DESC NULLS FIRST, CASE WHEN n > 10 THEN 0 ELSE 1 END,
         n_name, c_custkey, revenue, n LIMIT 50""")
def op_sort_expr(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    x = _cust_rev(t)
    return topk(x, [desc(c("revenue") / c("n")), asc(F.when(c("n") > 10, 0).otherwise(1))], 50)


@register("op_topk", prelude="ops", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM od
ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey LIMIT 100""")
def op_topk(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return topk(t.od.select("o_orderkey", "o_custkey", "o_totalprice"), ["-o_totalprice", "o_orderkey"])


@register("op_limit_only", prelude="ops", sql="""
SELECT count(*) AS n, CAST(sum(o_totalprice) AS DECIMAL(38,2)) AS total FROM od LIMIT 100""")
def op_limit_only(spark, sf_dir):
    """LIMIT on an already aggregated one-row result."""
    t = OrderEntry(spark, sf_dir)
    return t.od.agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("decimal(38,2)").alias("total")).limit(100)
