"""Several scalar subqueries over one fact, merged into one scan.

The text computes each number with its own scan (q09: 15 scalar
subqueries; q28: 6; q88: 8; q90: 2; q61: 2) and puts the one-row results
side by side with a cartesian product.  Each is one aggregation here with
conditional aggregates, so the fact is read once and no cross product of
partial results is formed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import avg4, quotient4
from ...operators.joins import attach_scalar
from ..registry import register
from .common import Tables

c = F.col

# The statement's five quantity bands.
Q09_BANDS = [(1, 20), (21, 40), (41, 60), (61, 80), (81, 100)]


@register("q09")
def q09(spark, sf_dir, t1=2000, t2=2000, t3=5000, t4=5000, t5=3000, value_col="ss_net_profit"):
    """``value_col`` is the column parameter of the template (net profit or
    net paid, depending on scale)."""
    t = Tables(spark, sf_dir)
    ss = t.store_sales.select("ss_quantity", "ss_ext_discount_amt", value_col)
    aggs = []
    for i, (lo, hi) in enumerate(Q09_BANDS):
        inb = c("ss_quantity").between(lo, hi)
        aggs += [F.count(F.when(inb, 1)).alias(f"n{i}"), avg4(F.when(inb, c("ss_ext_discount_amt"))).alias(f"d{i}"),
                 avg4(F.when(inb, c(value_col))).alias(f"v{i}")]
    one = ss.agg(*aggs)
    th = [t1, t2, t3, t4, t5]
    one = one.select(*[F.when(c(f"n{i}") > th[i], c(f"d{i}")).otherwise(c(f"v{i}")).alias(f"bucket{i + 1}")
                       for i in range(5)])
    return attach_scalar(t.reason.filter(c("r_reason_sk") == 1).select("r_reason_sk"), one).drop("r_reason_sk")


# The statement's six buckets (quantity low, high, list price,
# coupon amount, wholesale cost lower bounds).
Q28_BUCKETS = [(0, 5, 11, 460, 14), (6, 10, 91, 1430, 32), (11, 15, 66, 920, 4),
               (16, 20, 142, 3054, 80), (21, 25, 135, 14180, 38), (26, 30, 28, 2513, 42)]


@register("q28")
def q28(spark, sf_dir):
    t = Tables(spark, sf_dir)
    # the quantity bands are disjoint, so a row is in one band at most: counts
    # per band and list price give the sums and the distinct prices
    band = None
    for i, (qlo, qhi, lp, cp, wc) in enumerate(Q28_BUCKETS):
        cond = (c("ss_quantity").between(qlo, qhi)
                & (c("ss_list_price").between(lp, lp + 10) | c("ss_coupon_amt").between(cp, cp + 1000)
                   | c("ss_wholesale_cost").between(wc, wc + 20)))
        band = F.when(cond, i) if band is None else band.when(cond, i)
    per_price = (t.store_sales.select("ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_wholesale_cost")
                 .filter(c("ss_quantity").between(Q28_BUCKETS[0][0], Q28_BUCKETS[-1][1]) & c("ss_list_price").isNotNull())
                 .select(band.alias("band"), "ss_list_price").filter(c("band").isNotNull())
                 .groupBy("band", "ss_list_price").agg(F.count(F.lit(1)).alias("n"), F.sum("ss_list_price").alias("s")))
    per_band = per_price.groupBy("band").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("prices"))
    aggs = []
    for i in range(len(Q28_BUCKETS)):
        def of(name, i=i):
            return F.max(F.when(c("band") == i, c(name)))
        aggs += [quotient4(of("s"), of("n")).alias(f"B{i + 1}_LP"), F.coalesce(of("n"), F.lit(0)).alias(f"B{i + 1}_CNT"),
                 F.coalesce(of("prices"), F.lit(0)).alias(f"B{i + 1}_CNTD")]
    return per_band.agg(*aggs).limit(100)


# The statement's eight half-hour slots (name, hour, second half).
Q88_SLOTS = [("h8_30_to_9", 8, True), ("h9_to_9_30", 9, False), ("h9_30_to_10", 9, True),
             ("h10_to_10_30", 10, False), ("h10_30_to_11", 10, True), ("h11_to_11_30", 11, False),
             ("h11_30_to_12", 11, True), ("h12_to_12_30", 12, False)]


@register("q88")
def q88(spark, sf_dir, store_name="ese"):
    t = Tables(spark, sf_dir)
    dep, veh = c("hd_dep_count"), c("hd_vehicle_count")
    hd = t.household_demographics.filter(((dep == 3) & (veh <= 5)) | ((dep == 0) & (veh <= 2)) | ((dep == 1) & (veh <= 3))) \
        .select("hd_demo_sk")
    tm = t.time_dim.filter(c("t_hour").between(8, 12)).select("t_time_sk", "t_hour", "t_minute")
    j = (t.store_sales.select("ss_sold_time_sk", "ss_hdemo_sk", "ss_store_sk")
         .join(tm, c("ss_sold_time_sk") == c("t_time_sk")).join(hd, c("ss_hdemo_sk") == c("hd_demo_sk"))
         .join(t.store.filter(c("s_store_name") == store_name).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk")))
    aggs = [F.count(F.when((c("t_hour") == h) & ((c("t_minute") >= 30) if late else (c("t_minute") < 30)), 1)).alias(n)
            for n, h, late in Q88_SLOTS]
    return j.agg(*aggs)


@register("q90")
def q90(spark, sf_dir, am_hour=6, pm_hour=14, dep=8, chars_lo=5000, chars_hi=5200):
    t = Tables(spark, sf_dir)
    tm = t.time_dim.filter(c("t_hour").between(am_hour, am_hour + 1) | c("t_hour").between(pm_hour, pm_hour + 1)) \
        .select("t_time_sk", "t_hour")
    j = (t.web_sales.select("ws_sold_time_sk", "ws_ship_hdemo_sk", "ws_web_page_sk")
         .join(tm, c("ws_sold_time_sk") == c("t_time_sk"))
         .join(t.household_demographics.filter(c("hd_dep_count") == dep).select("hd_demo_sk"),
               c("ws_ship_hdemo_sk") == c("hd_demo_sk"))
         .join(t.web_page.filter(c("wp_char_count").between(chars_lo, chars_hi)).select("wp_web_page_sk"),
               c("ws_web_page_sk") == c("wp_web_page_sk")))
    one = j.agg(F.count(F.when(c("t_hour").between(am_hour, am_hour + 1), 1)).alias("amc"),
                F.count(F.when(c("t_hour").between(pm_hour, pm_hour + 1), 1)).alias("pmc"))
    # no afternoon sales: NULL ratio (the dialect would raise, DuckDB gives inf)
    return one.select(quotient4("amc", "pmc").alias("am_pm_ratio")).limit(100)


@register("q61")
def q61(spark, sf_dir, gmt=-5, category="Jewelry", year=2000, moy=11):
    t = Tables(spark, sf_dir)
    pr = t.promotion.filter((c("p_channel_dmail") == "Y") | (c("p_channel_email") == "Y") | (c("p_channel_tv") == "Y")) \
        .select("p_promo_sk")
    j = (t.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_promo_sk", "ss_customer_sk", "ss_item_sk",
                              "ss_ext_sales_price")
         .transform(t.on_days, "ss_sold_date_sk", t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk"))
         .join(t.store.filter(c("s_gmt_offset") == gmt).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk"))
         .join(t.customer.select("c_customer_sk", "c_current_addr_sk"), c("ss_customer_sk") == c("c_customer_sk"))
         .join(t.customer_address.filter(c("ca_gmt_offset") == gmt).select("ca_address_sk"),
               c("ca_address_sk") == c("c_current_addr_sk"))
         .join(t.item.filter(c("i_category") == category).select("i_item_sk"), c("ss_item_sk") == c("i_item_sk"))
         .join(pr, c("ss_promo_sk") == c("p_promo_sk"), "left"))
    one = j.agg(F.sum(F.when(c("p_promo_sk").isNotNull(), c("ss_ext_sales_price"))).cast("decimal(38,2)").alias("promotions"),
                F.sum("ss_ext_sales_price").cast("decimal(38,2)").alias("total"))
    return one.select("promotions", "total",
                      quotient4(c("promotions") * 100, c("total")).alias("promo_pct")).limit(100)
