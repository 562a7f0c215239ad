"""Scalar functions and expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import days_key, int_div, mean, quotient4, round_to_int
from ...sources.orderentry import OrderEntry
from ..registry import register

c = F.col


@register("op_arith", prelude="ops", sql="""
SELECT l_returnflag,
  CAST(sum(l_extendedprice * (1 - l_discount) + l_quantity * 2 - 1) AS DECIMAL(38,4)) AS net,
  CAST(sum(l_extendedprice * 0.95) AS DECIMAL(38,4)) AS scaled,
  count(*) * (2001 + 1) AS folded
FROM li GROUP BY l_returnflag""")
def op_arith(spark, sf_dir):
    """Decimal and integer arithmetic; constant sub-expressions fold at plan time."""
    t = OrderEntry(spark, sf_dir)
    p, d, q = c("l_extendedprice"), c("l_discount"), c("l_quantity")
    return t.li.groupBy("l_returnflag").agg(
        F.sum(p * (1 - d) + q * 2 - 1).cast("decimal(38,4)").alias("net"),
        F.sum(p * F.lit("0.95").cast("decimal(3,2)")).cast("decimal(38,4)").alias("scaled"),
        (F.count(F.lit(1)) * (2001 + 1)).alias("folded"))


@register("op_int_div", prelude="ops", sql="""
SELECT CAST(l_quantity // 7 AS BIGINT) AS qty_week, l_orderkey // 1000 AS order_block, count(*) AS n
FROM li GROUP BY l_quantity // 7, l_orderkey // 1000""")
def op_int_div(spark, sf_dir):
    """Integer / integer truncates in the suite's dialect."""
    t = OrderEntry(spark, sf_dir)
    return (t.li.groupBy(int_div("l_quantity", F.lit(7)).alias("qty_week"),
                         int_div("l_orderkey", F.lit(1000)).alias("order_block"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("op_safe_ratio", prelude="ops", sql="""
, y AS (SELECT o_custkey AS k,
              sum(CASE WHEN year(o_orderdate) = $y1 THEN o_totalprice ELSE 0 END) AS a,
              sum(CASE WHEN year(o_orderdate) = $y1 + 1 THEN o_totalprice ELSE 0 END) AS b
           FROM od GROUP BY o_custkey)
SELECT k AS custkey, CASE WHEN a > 0 THEN round(CAST(b * 1000000 AS DOUBLE) / CAST(a * 100 AS DOUBLE)) / 10000 ELSE NULL END AS growth FROM y""".replace("WITH , ", ", "))
def op_safe_ratio(spark, sf_dir, y1=1996):
    """CASE guard against a zero divisor (ANSI mode raises on / 0)."""
    t = OrderEntry(spark, sf_dir)
    yr = F.year("o_orderdate")
    z = F.lit(0).cast("decimal(12,2)")
    y = t.od.groupBy(c("o_custkey").alias("custkey")).agg(
        F.sum(F.when(yr == y1, c("o_totalprice")).otherwise(z)).alias("a"),
        F.sum(F.when(yr == y1 + 1, c("o_totalprice")).otherwise(z)).alias("b"))
    return y.select("custkey", F.when(c("a") > 0, quotient4("b", "a")).alias("growth"))


@register("op_case_searched", prelude="ops", sql="""
SELECT CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class,
       count(*) AS n
FROM li GROUP BY 1""")
def op_case_searched(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    q = c("l_quantity")
    k = F.when(q < 10, "small").when(q < 30, "medium").otherwise("large")
    return t.li.groupBy(k.alias("size_class")).agg(F.count(F.lit(1)).alias("n"))


@register("op_case_simple", prelude="ops", sql="""
SELECT CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'none' END AS state,
       count(*) AS n
FROM li GROUP BY 1""")
def op_case_simple(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    f = c("l_returnflag")
    k = F.when(f == "R", "returned").when(f == "A", "accepted").otherwise("none")
    return t.li.groupBy(k.alias("state")).agg(F.count(F.lit(1)).alias("n"))


@register("op_coalesce", prelude="ops", sql="""
SELECT o_orderpriority, CAST(sum(coalesce(r.q, 0)) AS BIGINT) AS returned_qty, count(*) AS orders
FROM od LEFT JOIN (SELECT l_orderkey AS k, sum(l_quantity) AS q FROM li WHERE l_returnflag = 'R'
                   GROUP BY l_orderkey) r ON o_orderkey = r.k
GROUP BY o_orderpriority""")
def op_coalesce(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    r = t.li.filter(c("l_returnflag") == "R").groupBy(c("l_orderkey").alias("k")).agg(F.sum("l_quantity").alias("q"))
    j = t.od.join(r, c("o_orderkey") == c("k"), "left")
    return j.groupBy("o_orderpriority").agg(F.sum(F.coalesce(c("q"), F.lit(0))).cast("bigint").alias("returned_qty"),
                                            F.count(F.lit(1)).alias("orders"))


@register("op_cast_decimal", prelude="ops", sql="""
SELECT l_returnflag,
       CAST(CAST(sum(l_extendedprice) AS DOUBLE) / count(*) AS DECIMAL(15,4)) AS avg_price,
       CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(17,2)) AS qty
FROM li GROUP BY l_returnflag""")
def op_cast_decimal(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy("l_returnflag").agg(
        (F.sum("l_extendedprice").cast("double") / F.count(F.lit(1))).cast("decimal(15,4)").alias("avg_price"),
        F.sum(c("l_quantity").cast("decimal(12,2)")).cast("decimal(17,2)").alias("qty"))


@register("op_cast_int_bucket", prelude="ops", sql="""
SELECT CAST(round(l_extendedprice / 5000) AS INT) AS bucket, count(*) AS n
FROM li GROUP BY 1""")
def op_cast_int_bucket(spark, sf_dir):
    """Decimal to int rounds in the suite's dialect (Spark's cast truncates)."""
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy(round_to_int(c("l_extendedprice") / 5000).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@register("op_cast_date", prelude="ops", sql="""
SELECT count(*) AS n FROM od WHERE o_orderdate = CAST('$day' AS DATE)""")
def op_cast_date(spark, sf_dir, day="1996-03-01"):
    t = OrderEntry(spark, sf_dir)
    return t.od.filter(c("o_orderdate") == F.to_date(F.lit(day))).agg(F.count(F.lit(1)).alias("n"))


@register("op_date_add", prelude="ops", sql="""
SELECT o_orderstatus, count(*) AS n FROM od
WHERE o_orderdate BETWEEN CAST('$day' AS DATE) AND CAST('$day' AS DATE) + INTERVAL 30 DAY
GROUP BY o_orderstatus""")
def op_date_add(spark, sf_dir, day="1996-01-01"):
    t = OrderEntry(spark, sf_dir)
    d0 = F.to_date(F.lit(day))
    return (t.od.filter(c("o_orderdate").between(d0, F.date_add(d0, 30)))
            .groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@register("op_date_sub", prelude="ops", sql="""
SELECT l_linestatus, count(*) AS n FROM li JOIN od ON l_orderkey = o_orderkey
WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 5 DAY AND o_orderdate + INTERVAL 5 DAY
GROUP BY l_linestatus""")
def op_date_sub(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    j = t.li.join(t.od, c("l_orderkey") == c("o_orderkey"))
    return (j.filter(c("l_shipdate").between(F.date_sub("o_orderdate", 5), F.date_add("o_orderdate", 5)))
            .groupBy("l_linestatus").agg(F.count(F.lit(1)).alias("n")))


@register("op_datekey_diff", prelude="ops", sql="""
SELECT o_orderpriority,
  CAST(min((2450815 + (l_shipdate - DATE '1998-01-01')) - (2450815 + (o_orderdate - DATE '1998-01-01'))) AS INTEGER) AS min_lag,
  CAST(max((2450815 + (l_shipdate - DATE '1998-01-01')) - (2450815 + (o_orderdate - DATE '1998-01-01'))) AS INTEGER) AS max_lag,
  CAST(sum((2450815 + (l_shipdate - DATE '1998-01-01')) - (2450815 + (o_orderdate - DATE '1998-01-01'))) AS BIGINT) AS sum_lag
FROM li JOIN od ON l_orderkey = o_orderkey GROUP BY o_orderpriority""")
def op_datekey_diff(spark, sf_dir):
    """Differences of integer day keys (``*_date_sk`` arithmetic)."""
    t = OrderEntry(spark, sf_dir)
    j = t.li.join(t.od, c("l_orderkey") == c("o_orderkey"))
    lag = days_key("l_shipdate") - days_key("o_orderdate")
    return j.groupBy("o_orderpriority").agg(F.min(lag).alias("min_lag"), F.max(lag).alias("max_lag"),
                                            F.sum(lag).cast("bigint").alias("sum_lag"))


@register("op_substr", prelude="ops", sql="""
SELECT substr(p_name, 1, 4) AS prefix, count(*) AS n FROM pa GROUP BY 1""")
def op_substr(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return t.pa.groupBy(F.substring("p_name", 1, 4).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


@register("op_upper", prelude="ops", sql="""
SELECT upper(p_type) AS ptype, count(*) AS n FROM pa WHERE upper(p_name) LIKE 'BLUE%' GROUP BY 1""")
def op_upper(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return (t.pa.filter(F.upper("p_name").like("BLUE%")).groupBy(F.upper("p_type").alias("ptype"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("op_concat", prelude="ops", sql="""
SELECT p_brand || '-' || p_type AS label, count(*) AS n FROM pa GROUP BY 1""")
def op_concat(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    return (t.pa.groupBy(F.concat("p_brand", F.lit("-"), "p_type").alias("label"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("op_round", prelude="ops", sql="""
SELECT l_returnflag, CAST(sum(round(l_extendedprice * l_discount, 1)) AS DECIMAL(38,1)) AS disc_amt,
       round(CAST(sum(l_extendedprice) AS DECIMAL(38,2)) / count(*), 2) AS avg_price
FROM li GROUP BY l_returnflag""")
def op_round(spark, sf_dir):
    """Round half away from zero on exact decimals."""
    t = OrderEntry(spark, sf_dir)
    return t.li.groupBy("l_returnflag").agg(
        F.sum(F.round(c("l_extendedprice") * c("l_discount"), 1)).cast("decimal(38,1)").alias("disc_amt"),
        F.round((F.sum("l_extendedprice").cast("decimal(38,2)") / F.count(F.lit(1))).cast("double"), 2)
        .alias("avg_price"))


@register("op_abs", prelude="ops", sql="""
WITH , m AS (SELECT o_custkey AS k, sum(o_totalprice) AS total FROM od GROUP BY o_custkey)
SELECT k AS custkey, CAST(abs(total - (SELECT avg(total) FROM m)) AS DECIMAL(38,2)) AS deviation
FROM m""".replace("WITH , ", ", "))
def op_abs(spark, sf_dir):
    t = OrderEntry(spark, sf_dir)
    from ...operators.joins import attach_scalar
    m = t.od.groupBy(c("o_custkey").alias("custkey")).agg(F.sum("o_totalprice").alias("total"))
    avg = m.agg(mean("total").alias("avg_total"))
    return attach_scalar(m, avg).select("custkey", F.abs(c("total") - c("avg_total")).cast("decimal(38,2)")
                                        .alias("deviation"))
