"""Star-join group: one fact, a few filtered dimensions, aggregate, top-k.

Plan shape for all of these: the fact scan gets the pushed-down column
set, each dimension is filtered first, and the join build sides are the
filtered dimensions (broadcast by AQE only when their measured size is
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``); aggregation is
partial before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import avg4, mean, money_sum, r4
from ...operators.aggs import lag_buckets, pivot_sums
from ...operators.sorts import order, topk
from ...operators.subqueries import salted
from ...operators.windows import share_of
from ..registry import register
from .common import Tables


@register("q03")
def q03(spark, sf_dir, manufact_id=28, moy=12):
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter(F.col("d_moy") == moy).select("d_date_sk", "d_year")
    it = t.item.filter(F.col("i_manufact_id") == manufact_id).select("i_item_sk", "i_brand_id", "i_brand")
    ss = t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_ext_sales_price")
    j = (ss.transform(t.on_days, "ss_sold_date_sk", dt)
         .join(it, ss.ss_item_sk == it.i_item_sk))
    agg = (j.groupBy("d_year", "i_brand", "i_brand_id")
           .agg(money_sum("ss_ext_sales_price").alias("sum_agg"))
           .select("d_year", F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"),
                   "sum_agg"))
    return topk(agg, ["d_year", "-sum_agg", "brand_id"])


def _promo_avgs(t, fact, p, cdemo_col, gender, marital, education, year):
    """Q07 / Q26 shape: averages per item for one demographic under promotion."""
    cd = t.customer_demographics.filter((F.col("cd_gender") == gender) & (F.col("cd_marital_status") == marital)
                                        & (F.col("cd_education_status") == education)).select("cd_demo_sk")
    dt = t.date_dim.filter(F.col("d_year") == year).select("d_date_sk")
    pr = t.promotion.filter((F.col("p_channel_email") == "N") | (F.col("p_channel_event") == "N")).select("p_promo_sk")
    j = (fact.transform(t.on_days, f"{p}_sold_date_sk", dt)
         .join(cd, F.col(cdemo_col) == F.col("cd_demo_sk"))
         .join(pr, F.col(f"{p}_promo_sk") == F.col("p_promo_sk"))
         .join(t.item.select("i_item_sk", "i_item_id"), F.col(f"{p}_item_sk") == F.col("i_item_sk")))
    agg = j.groupBy("i_item_id").agg(avg4(f"{p}_quantity").alias("agg1"), avg4(f"{p}_list_price").alias("agg2"),
                                     avg4(f"{p}_coupon_amt").alias("agg3"), avg4(f"{p}_sales_price").alias("agg4"))
    return topk(agg, ["i_item_id"])


@register("q07")
def q07(spark, sf_dir, gender="F", marital="D", education="College", year=1998):
    t = Tables(spark, sf_dir)
    return _promo_avgs(t, t.store_sales, "ss", "ss_cdemo_sk", gender, marital, education, year)


@register("q26")
def q26(spark, sf_dir, gender="F", marital="D", education="College", year=1998):
    t = Tables(spark, sf_dir)
    return _promo_avgs(t, t.catalog_sales, "cs", "cs_bill_cdemo_sk", gender, marital, education, year)


@register("q15")
def q15(spark, sf_dir, zips=("10311", "10622", "13421", "16530", "19639", "85669"),
        states=("CA", "WA", "GA"), price=180, qoy=2, year=2000):
    """The OR spans three tables, so it is evaluated after the joins."""
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter((F.col("d_qoy") == qoy) & (F.col("d_year") == year)).select("d_date_sk")
    j = (t.catalog_sales.select("cs_sold_date_sk", "cs_bill_customer_sk", "cs_sales_price")
         .transform(t.on_days, "cs_sold_date_sk", dt)
         .join(t.customer.select("c_customer_sk", "c_current_addr_sk"),
               F.col("cs_bill_customer_sk") == F.col("c_customer_sk"))
         .join(t.customer_address.select("ca_address_sk", "ca_zip", "ca_state"),
               F.col("c_current_addr_sk") == F.col("ca_address_sk")))
    j = j.filter(F.substring("ca_zip", 1, 5).isin(list(zips)) | F.col("ca_state").isin(list(states))
                 | (F.col("cs_sales_price") > price))
    agg = j.groupBy("ca_zip").agg(money_sum("cs_sales_price").alias("sum_sales_price"))
    return topk(agg, ["ca_zip"])


@register("q19")
def q19(spark, sf_dir, manager_id=7, moy=11, year=1999):
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter((F.col("d_moy") == moy) & (F.col("d_year") == year)).select("d_date_sk")
    it = t.item.filter(F.col("i_manager_id") == manager_id).select(
        "i_item_sk", "i_brand_id", "i_brand", "i_manufact_id", "i_manufact")
    j = (t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_customer_sk", "ss_store_sk", "ss_ext_sales_price")
         .transform(t.on_days, "ss_sold_date_sk", dt)
         .join(it, F.col("ss_item_sk") == F.col("i_item_sk"))
         .join(t.customer.select("c_customer_sk", "c_current_addr_sk"), F.col("ss_customer_sk") == F.col("c_customer_sk"))
         .join(t.customer_address.select("ca_address_sk", "ca_zip"), F.col("c_current_addr_sk") == F.col("ca_address_sk"))
         .join(t.store.select("s_store_sk", "s_zip"),
               (F.col("ss_store_sk") == F.col("s_store_sk"))
               & (F.substring("ca_zip", 1, 5) != F.substring("s_zip", 1, 5))))
    agg = (j.groupBy("i_brand", "i_brand_id", "i_manufact_id", "i_manufact")
           .agg(money_sum("ss_ext_sales_price").alias("ext_price"))
           .select(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"),
                   "i_manufact_id", "i_manufact", "ext_price"))
    return topk(agg, ["-ext_price", "brand", "brand_id", "i_manufact_id", "i_manufact"])


@register("q42")
def q42(spark, sf_dir, manager_id=1, moy=12, year=1998):
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter((F.col("d_moy") == moy) & (F.col("d_year") == year)).select("d_date_sk", "d_year")
    it = t.item.filter(F.col("i_manager_id") == manager_id).select("i_item_sk", "i_category_id", "i_category")
    j = (t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_ext_sales_price")
         .transform(t.on_days, "ss_sold_date_sk", dt)
         .join(it, F.col("ss_item_sk") == F.col("i_item_sk")))
    agg = j.groupBy("d_year", "i_category_id", "i_category").agg(
        money_sum("ss_ext_sales_price").alias("sum_sales"))
    return topk(agg, ["-sum_sales", "d_year", "i_category_id", "i_category"])


_DAYS = {"sun_sales": "Sunday", "mon_sales": "Monday", "tue_sales": "Tuesday", "wed_sales": "Wednesday",
         "thu_sales": "Thursday", "fri_sales": "Friday", "sat_sales": "Saturday"}


@register("q43")
def q43(spark, sf_dir, gmt=-5, year=1998):
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter(F.col("d_year") == year).select("d_date_sk", "d_day_name")
    st = t.store.filter(F.col("s_gmt_offset") == gmt).select("s_store_sk", "s_store_name", "s_store_id")
    j = (t.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_sales_price")
         .transform(t.on_days, "ss_sold_date_sk", dt)
         .join(st, F.col("ss_store_sk") == F.col("s_store_sk")))
    agg = j.groupBy("s_store_name", "s_store_id").agg(
        *[x.cast("decimal(38,2)").alias(a) for x, a in zip(pivot_sums("d_day_name", _DAYS, "ss_sales_price"), _DAYS)])
    return topk(agg, ["s_store_name", "s_store_id", *_DAYS])


def _bands_filter(demo_bands, addr_bands, with_hdemo):
    """OR-ed (demographic, price) and (state, profit) bands.  Every branch of
    the suite's text repeats the same join keys; they are factored out into
    the joins, so only these residual ORs remain (no cartesian product)."""
    c = F.col
    d = None
    for b in demo_bands:
        x = ((c("cd_marital_status") == b[0]) & (c("cd_education_status") == b[1])
             & c("ss_sales_price").between(b[2], b[3]))
        if with_hdemo:
            x = x & (c("hd_dep_count") == b[4])
        d = x if d is None else d | x
    a = None
    for states, lo, hi in addr_bands:
        x = (c("ca_country") == "United States") & c("ca_state").isin(list(states)) & c("ss_net_profit").between(lo, hi)
        a = x if a is None else a | x
    return d & a


def _store_demo_addr(t, year, with_hdemo):
    c = F.col
    j = (t.store_sales.join(t.store.select("s_store_sk"), c("s_store_sk") == c("ss_store_sk"))
         .transform(t.on_days, "ss_sold_date_sk", t.date_dim.filter(c("d_year") == year).select("d_date_sk"))
         .join(t.customer_demographics.select("cd_demo_sk", "cd_marital_status", "cd_education_status"),
               c("cd_demo_sk") == c("ss_cdemo_sk"))
         .join(t.customer_address.select("ca_address_sk", "ca_country", "ca_state"), c("ss_addr_sk") == c("ca_address_sk")))
    if with_hdemo:
        j = j.join(t.household_demographics.select("hd_demo_sk", "hd_dep_count"), c("ss_hdemo_sk") == c("hd_demo_sk"))
    return j


@register("q48")
def q48(spark, sf_dir, year=1998, marital="M", education="2 yr Degree",
        states1=("KY", "GA", "NM"), states2=("TN", "OH", "IN"), states3=("WA", "CA", "TX")):
    t = Tables(spark, sf_dir)
    demo = [(marital, education, lo, hi) for lo, hi in ((100, 150), (50, 100), (150, 200))]
    addr = [(states1, 0, 2000), (states2, 150, 3000), (states3, 50, 25000)]
    j = _store_demo_addr(t, year, False).filter(_bands_filter(demo, addr, False))
    return j.agg(F.sum("ss_quantity").cast("bigint").alias("sum_quantity"))


@register("q13")
def q13(spark, sf_dir, year=2000, m1="M", e1="4 yr Degree", dep1=4, m2="D", e2="Primary", dep2=3,
        m3="D", e3="Secondary", dep3=9,
        states1=("KY", "GA", "NM"), states2=("TN", "OH", "IN"), states3=("WA", "CA", "TX")):
    t = Tables(spark, sf_dir)
    demo = [(m1, e1, 100, 150, dep1), (m2, e2, 50, 100, dep2), (m3, e3, 150, 200, dep3)]
    addr = [(states1, 0, 2000), (states2, 150, 3000), (states3, 50, 25000)]
    j = _store_demo_addr(t, year, True).filter(_bands_filter(demo, addr, True))
    return j.agg(avg4("ss_quantity").alias("avg_quantity"), avg4("ss_ext_sales_price").alias("avg_ext_sales_price"),
                 avg4("ss_ext_wholesale_cost").alias("avg_ext_wholesale_cost"),
                 money_sum("ss_ext_wholesale_cost").alias("sum_ext_wholesale_cost"))


def _brand_month(t, manager_id, moy, year):
    c = F.col
    dt = t.date_dim.filter((c("d_moy") == moy) & (c("d_year") == year)).select("d_date_sk", "d_year")
    it = t.item.filter(c("i_manager_id") == manager_id).select("i_item_sk", "i_brand_id", "i_brand")
    return (t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_ext_sales_price")
            .transform(t.on_days, "ss_sold_date_sk", dt).join(it, c("ss_item_sk") == c("i_item_sk")))


@register("q52")
def q52(spark, sf_dir, manager_id=1, moy=12, year=1998):
    t = Tables(spark, sf_dir)
    agg = (_brand_month(t, manager_id, moy, year).groupBy("d_year", "i_brand", "i_brand_id")
           .agg(money_sum("ss_ext_sales_price").alias("ext_price"))
           .select("d_year", F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"), "ext_price"))
    return topk(agg, ["d_year", "-ext_price", "brand_id"])


@register("q55")
def q55(spark, sf_dir, manager_id=13, moy=12, year=2000):
    t = Tables(spark, sf_dir)
    agg = (_brand_month(t, manager_id, moy, year).groupBy("i_brand", "i_brand_id")
           .agg(money_sum("ss_ext_sales_price").alias("ext_price"))
           .select(F.col("i_brand_id").alias("brand_id"), F.col("i_brand").alias("brand"), "ext_price"))
    return topk(agg, ["-ext_price", "brand_id"])


LAG_NAMES = ["30 days", "31-60 days", "61-90 days", "91-120 days", ">120 days"]
STORE_ADDR = ["s_store_name", "s_company_id", "s_street_number", "s_street_name", "s_street_type",
              "s_suite_number", "s_city", "s_county", "s_state", "s_zip"]


@register("q50")
def q50(spark, sf_dir, year=2000, moy=9):
    """Sale and its return matched on (ticket, item, customer); buckets of the
    day-key difference."""
    t = Tables(spark, sf_dir)
    c = F.col
    d2 = t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select(c("d_date_sk").alias("d2_sk"))
    sr = (t.store_returns.select("sr_ticket_number", "sr_item_sk", "sr_customer_sk", "sr_returned_date_sk")
          .transform(t.on_days, "sr_returned_date_sk", d2, "d2_sk"))
    j = (t.store_sales.select("ss_ticket_number", "ss_item_sk", "ss_customer_sk", "ss_sold_date_sk", "ss_store_sk")
         .join(sr, (c("ss_ticket_number") == c("sr_ticket_number")) & (c("ss_item_sk") == c("sr_item_sk"))
               & (c("ss_customer_sk") == c("sr_customer_sk")))
         .join(t.date_dim.select(c("d_date_sk").alias("d1_sk")), c("ss_sold_date_sk") == c("d1_sk"))
         .join(t.store.select("s_store_sk", *STORE_ADDR), c("ss_store_sk") == c("s_store_sk")))
    agg = j.groupBy(*STORE_ADDR).agg(*lag_buckets(c("sr_returned_date_sk") - c("ss_sold_date_sk"), names=LAG_NAMES))
    return topk(agg, STORE_ADDR)


def _ship_lag(t, fact, p, outlet_df, outlet_key, outlet_name, month_seq):
    """Q62 / Q99 shape: shipping-lag buckets by warehouse, ship mode and outlet."""
    c = F.col
    dt = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    j = (fact.select(f"{p}_ship_date_sk", f"{p}_sold_date_sk", f"{p}_warehouse_sk", f"{p}_ship_mode_sk", outlet_key)
         .join(dt, c(f"{p}_ship_date_sk") == c("d_date_sk"))
         .join(t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), c(f"{p}_warehouse_sk") == c("w_warehouse_sk"))
         .join(t.ship_mode.select("sm_ship_mode_sk", "sm_type"), c(f"{p}_ship_mode_sk") == c("sm_ship_mode_sk"))
         .join(outlet_df, c(outlet_key) == c(outlet_df.columns[0])))
    agg = (j.groupBy(F.substring("w_warehouse_name", 1, 20).alias("wh_name"), "sm_type", outlet_name)
           .agg(*lag_buckets(c(f"{p}_ship_date_sk") - c(f"{p}_sold_date_sk"), names=LAG_NAMES)))
    return topk(agg, ["wh_name", "sm_type", outlet_name])


@register("q62")
def q62(spark, sf_dir, month_seq=1188):
    t = Tables(spark, sf_dir)
    return _ship_lag(t, t.web_sales, "ws", t.web_site.select("web_site_sk", "web_name"), "ws_web_site_sk",
                     "web_name", month_seq)


@register("q99")
def q99(spark, sf_dir, month_seq=1188):
    t = Tables(spark, sf_dir)
    return _ship_lag(t, t.catalog_sales, "cs", t.call_center.select("cc_call_center_sk", "cc_name"),
                     "cs_call_center_sk", "cc_name", month_seq)


@register("q96")
def q96(spark, sf_dir, hour=8, minute=30, dep_count=5, store_name="ese"):
    t = Tables(spark, sf_dir)
    c = F.col
    j = (t.store_sales.select("ss_sold_time_sk", "ss_hdemo_sk", "ss_store_sk")
         .join(t.time_dim.filter((c("t_hour") == hour) & (c("t_minute") >= minute)).select("t_time_sk"),
               c("ss_sold_time_sk") == c("t_time_sk"))
         .join(t.household_demographics.filter(c("hd_dep_count") == dep_count).select("hd_demo_sk"),
               c("ss_hdemo_sk") == c("hd_demo_sk"))
         .join(t.store.filter(c("s_store_name") == store_name).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk")))
    return j.agg(F.count(F.lit(1)).alias("cnt")).limit(100)


def _class_share(t, fact, p, categories, start, limit):
    """Q12 / Q20 / Q98: item revenue in a 30-day window and its share of the
    class total.  The window runs over the aggregate (one row per item)."""
    c = F.col
    d0 = F.lit(start).cast("date")
    dt = t.date_dim.filter(c("d_date").between(d0, F.date_add(d0, 30))).select("d_date_sk")
    it = t.item.filter(c("i_category").isin(list(categories))).select(
        "i_item_sk", "i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price")
    j = (fact.select(f"{p}_item_sk", f"{p}_sold_date_sk", f"{p}_ext_sales_price")
         .transform(t.on_days, f"{p}_sold_date_sk", dt).join(it, c(f"{p}_item_sk") == c("i_item_sk")))
    agg = (j.groupBy("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price")
           .agg(F.sum(f"{p}_ext_sales_price").alias("rev"))
           .select("i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price",
                   c("rev").cast("decimal(38,2)").alias("itemrevenue"),
                   share_of("rev", ["i_class"]).alias("revenueratio")))
    keys = ["i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio"]
    out = topk(agg, keys) if limit else order(agg, keys)
    return out.drop("i_item_id")


@register("q12")
def q12(spark, sf_dir, categories=("Jewelry", "Sports", "Books"), start="2001-01-12"):
    t = Tables(spark, sf_dir)
    return _class_share(t, t.web_sales, "ws", categories, start, True)


@register("q20")
def q20(spark, sf_dir, categories=("Jewelry", "Sports", "Books"), start="2001-01-12"):
    t = Tables(spark, sf_dir)
    return _class_share(t, t.catalog_sales, "cs", categories, start, True)


@register("q98")
def q98(spark, sf_dir, categories=("Jewelry", "Sports", "Books"), start="2001-01-12"):
    t = Tables(spark, sf_dir)
    return _class_share(t, t.store_sales, "ss", categories, start, False)


@register("q65")
def q65(spark, sf_dir, month_seq=1188, factor=0.1):
    """Store items whose revenue is at most 10% of the store's average item
    revenue: the per-(store, item) aggregate is built once and both used
    directly and re-aggregated per store (aggregate of an aggregate)."""
    t = Tables(spark, sf_dir)
    c = F.col
    dt = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    sc = (t.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_item_sk", "ss_sales_price")
          .transform(t.on_days, "ss_sold_date_sk", dt)
          .groupBy("ss_store_sk", "ss_item_sk").agg(F.sum("ss_sales_price").alias("revenue")))
    sb = sc.groupBy(c("ss_store_sk").alias("sb_store")).agg(mean("revenue").alias("ave"))
    sc, sb, part = salted(sc, sb, 64, ["ss_item_sk"])  # stores are few and hot
    j = (sc.join(sb, part & (c("sb_store") == c("ss_store_sk")) & (c("revenue") <= F.lit(factor) * c("ave")))
         .join(t.store.select("s_store_sk", "s_store_name"), c("s_store_sk") == c("ss_store_sk"))
         .join(t.item.select("i_item_sk", "i_item_desc", "i_current_price", "i_wholesale_cost", "i_brand"),
               c("i_item_sk") == c("ss_item_sk")))
    out = j.select("s_store_name", "i_item_desc", c("revenue").cast("decimal(38,2)").alias("revenue"),
                   "i_current_price", "i_wholesale_cost", "i_brand")
    return topk(out, ["s_store_name", "i_item_desc"])


MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
W_ATTRS = ["w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country"]


@register("q66")
def q66(spark, sf_dir, year=2000, time_lo=49530, carrier1="DIAMOND", carrier2="AIRBORNE"):
    """Monthly warehouse sales for two carriers: 24 conditional sums per
    channel (one pass each), union, re-aggregate, per-square-foot ratios."""
    t = Tables(spark, sf_dir)
    c = F.col
    d = t.date_dim.filter(c("d_year") == year).select("d_date_sk", "d_year", "d_moy")
    tm = t.time_dim.filter(c("t_time").between(time_lo, time_lo + 28800)).select("t_time_sk")
    sm = t.ship_mode.filter(c("sm_carrier").isin(carrier1, carrier2)).select("sm_ship_mode_sk")
    w = t.warehouse.select("w_warehouse_sk", *W_ATTRS)

    def chan(fact, p, price, net):
        j = (fact.join(w, c(f"{p}_warehouse_sk") == c("w_warehouse_sk")).transform(t.on_days, f"{p}_sold_date_sk", d)
             .join(tm, c(f"{p}_sold_time_sk") == c("t_time_sk")).join(sm, c(f"{p}_ship_mode_sk") == c("sm_ship_mode_sk")))
        aggs = []
        for i, m in enumerate(MONTHS):
            hit = c("d_moy") == i + 1
            aggs.append(F.sum(F.when(hit, c(price) * c(f"{p}_quantity")).otherwise(0)).alias(f"{m}_sales"))
        for i, m in enumerate(MONTHS):
            hit = c("d_moy") == i + 1
            aggs.append(F.sum(F.when(hit, c(net) * c(f"{p}_quantity")).otherwise(0)).alias(f"{m}_net"))
        return (j.groupBy(*W_ATTRS, c("d_year").alias("year")).agg(*aggs)
                .withColumn("ship_carriers", F.lit(f"{carrier1},{carrier2}")))
    u = chan(t.web_sales, "ws", "ws_sales_price", "ws_net_paid_inc_tax").unionByName(
        chan(t.catalog_sales, "cs", "cs_ext_sales_price", "cs_net_paid_inc_ship_tax"))
    aggs = ([F.sum(f"{m}_sales").cast("decimal(38,2)").alias(f"{m}_sales") for m in MONTHS]
            + [r4(F.sum(c(f"{m}_sales") / c("w_warehouse_sq_ft"))).alias(f"{m}_sales_per_sq_foot") for m in MONTHS]
            + [F.sum(f"{m}_net").cast("decimal(38,2)").alias(f"{m}_net") for m in MONTHS])
    g = u.groupBy(*W_ATTRS, "ship_carriers", "year").agg(*aggs)
    return topk(g, ["w_warehouse_name"])


@register("q71")
def q71(spark, sf_dir, manager_id=1, moy=12, year=1999, meals=("breakfast", "dinner")):
    t = Tables(spark, sf_dir)
    c = F.col
    d = t.date_dim.filter((c("d_moy") == moy) & (c("d_year") == year)).select("d_date_sk")
    parts = []
    for fact, p in ((t.web_sales, "ws"), (t.catalog_sales, "cs"), (t.store_sales, "ss")):
        parts.append(fact.transform(t.on_days, f"{p}_sold_date_sk", d)
                     .select(c(f"{p}_ext_sales_price").alias("ext_price"), c(f"{p}_item_sk").alias("sold_item_sk"),
                             c(f"{p}_sold_time_sk").alias("time_sk")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    j = (u.join(t.item.filter(c("i_manager_id") == manager_id).select("i_item_sk", "i_brand_id", "i_brand"),
                c("sold_item_sk") == c("i_item_sk"))
         .join(t.time_dim.filter(c("t_meal_time").isin(list(meals))).select("t_time_sk", "t_hour", "t_minute"),
               c("time_sk") == c("t_time_sk")))
    g = (j.groupBy("i_brand", "i_brand_id", "t_hour", "t_minute").agg(money_sum("ext_price").alias("ext_price"))
         .select(c("i_brand_id").alias("brand_id"), c("i_brand").alias("brand"), "t_hour", "t_minute", "ext_price"))
    return order(g, ["-ext_price", "brand_id"])


@register("q72")
def q72(spark, sf_dir, potential="1001-5000", marital="M", year=2000, ship_lag=5):
    """Catalog orders that exceed the stock on hand in the same week.  The
    text joins inventory on the item and compares weeks afterwards; here
    (item, week) is the equi-join key, so each sale meets only the stock
    rows of its own week.  Both COUNTs over CASE .. ELSE 0 count every row
    (kept)."""
    t = Tables(spark, sf_dir)
    c = F.col
    d1 = t.date_dim.filter(c("d_year") == year).select(c("d_date_sk").alias("d1_sk"), c("d_week_seq").alias("d1_week"),
                                                       c("d_date").alias("d1_date"))
    d3 = t.date_dim.select(c("d_date_sk").alias("d3_sk"), c("d_date").alias("d3_date"))
    # stock of the weeks of that year only
    weeks = d1.select(c("d1_week").alias("week")).distinct()
    d2 = (t.date_dim.select(c("d_date_sk").alias("d2_sk"), c("d_week_seq").alias("d2_week"))
          .join(weeks, c("d2_week") == c("week"), "left_semi"))
    inv = (t.inventory.transform(t.on_days, "inv_date_sk", d2, "d2_sk")
           .join(t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), c("w_warehouse_sk") == c("inv_warehouse_sk")))
    cs = (t.catalog_sales.select("cs_item_sk", "cs_order_number", "cs_bill_cdemo_sk", "cs_bill_hdemo_sk",
                                 "cs_sold_date_sk", "cs_ship_date_sk", "cs_promo_sk", "cs_quantity")
          .transform(t.on_days, "cs_sold_date_sk", d1, "d1_sk")
          .join(t.customer_demographics.filter(c("cd_marital_status") == marital).select("cd_demo_sk"),
                c("cs_bill_cdemo_sk") == c("cd_demo_sk"))
          .join(t.household_demographics.filter(c("hd_buy_potential") == potential).select("hd_demo_sk"),
                c("cs_bill_hdemo_sk") == c("hd_demo_sk"))
          .join(d3, (c("cs_ship_date_sk") == c("d3_sk")) & (c("d3_date") > F.date_add(c("d1_date"), ship_lag))))
    j = (cs.join(inv, (c("cs_item_sk") == c("inv_item_sk")) & (c("d1_week") == c("d2_week"))
                 & (c("inv_quantity_on_hand") < c("cs_quantity")))
         .join(t.item.select("i_item_sk", "i_item_desc"), c("i_item_sk") == c("cs_item_sk"))
         .join(t.promotion.select("p_promo_sk"), c("cs_promo_sk") == c("p_promo_sk"), "left")
         .join(t.catalog_returns.select("cr_item_sk", "cr_order_number"),
               (c("cr_item_sk") == c("cs_item_sk")) & (c("cr_order_number") == c("cs_order_number")), "left"))
    g = j.groupBy("i_item_desc", "w_warehouse_name", c("d1_week").alias("d_week_seq")).agg(
        F.count(F.when(c("p_promo_sk").isNull(), 1).otherwise(0)).alias("no_promo"),
        F.count(F.when(c("p_promo_sk").isNotNull(), 1).otherwise(0)).alias("promo"),
        F.count(F.lit(1)).alias("total_cnt"))
    return topk(g, ["-total_cnt", "i_item_desc", "w_warehouse_name", "d_week_seq"])


@register("q84")
def q84(spark, sf_dir, city="Midway", income_lo=32287):
    t = Tables(spark, sf_dir)
    c = F.col
    ib = t.income_band.filter((c("ib_lower_bound") >= income_lo) & (c("ib_upper_bound") <= income_lo + 50000)) \
        .select("ib_income_band_sk")
    hd = t.household_demographics.join(ib, c("ib_income_band_sk") == c("hd_income_band_sk")).select("hd_demo_sk")
    cu = (t.customer.select("c_customer_id", "c_last_name", "c_first_name", "c_current_addr_sk", "c_current_cdemo_sk",
                            "c_current_hdemo_sk")
          .join(t.customer_address.filter(c("ca_city") == city).select("ca_address_sk"),
                c("c_current_addr_sk") == c("ca_address_sk"))
          .join(hd, c("hd_demo_sk") == c("c_current_hdemo_sk"))
          .join(t.customer_demographics.select("cd_demo_sk"), c("cd_demo_sk") == c("c_current_cdemo_sk")))
    # a customer comes once per return of the same demographic: count those,
    # keep the first hundred customers, and repeat only them
    per_demo = (t.store_returns.filter(c("sr_cdemo_sk").isNotNull()).groupBy(c("sr_cdemo_sk").alias("demo"))
                .agg(F.count(F.lit(1)).alias("times")))
    named = (cu.join(per_demo, c("demo") == c("cd_demo_sk"))
             .select(c("c_customer_id").alias("customer_id"),
                     F.concat(c("c_last_name"), F.lit(", "), c("c_first_name")).alias("customername"), "times"))
    first = topk(named, ["customer_id"])
    out = first.withColumn("again", F.explode(F.sequence(F.lit(1), F.least("times", F.lit(100).cast("long")).cast("int"))))
    return topk(out.select("customer_id", "customername"), ["customer_id"])


@register("q91")
def q91(spark, sf_dir, year=1999, moy=11, m1="M", e1="4 yr Degree", m2="D", e2="Unknown",
        potential_prefix="0-500", gmt=-7):
    t = Tables(spark, sf_dir)
    c = F.col
    cd = t.customer_demographics.filter(((c("cd_marital_status") == m1) & (c("cd_education_status") == e1))
                                        | ((c("cd_marital_status") == m2) & (c("cd_education_status") == e2)))
    j = (t.catalog_returns.select("cr_call_center_sk", "cr_returned_date_sk", "cr_returning_customer_sk", "cr_net_loss")
         .transform(t.on_days, "cr_returned_date_sk", t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk"))
         .join(t.call_center.select("cc_call_center_sk", "cc_call_center_id", "cc_name", "cc_manager"),
               c("cr_call_center_sk") == c("cc_call_center_sk"))
         .join(t.customer.select("c_customer_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_current_addr_sk"),
               c("cr_returning_customer_sk") == c("c_customer_sk"))
         .join(cd.select("cd_demo_sk", "cd_marital_status", "cd_education_status"), c("cd_demo_sk") == c("c_current_cdemo_sk"))
         .join(t.household_demographics.filter(c("hd_buy_potential").like(f"{potential_prefix}%")).select("hd_demo_sk"),
               c("hd_demo_sk") == c("c_current_hdemo_sk"))
         .join(t.customer_address.filter(c("ca_gmt_offset") == gmt).select("ca_address_sk"),
               c("ca_address_sk") == c("c_current_addr_sk")))
    g = (j.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status", "cd_education_status")
         .agg(money_sum("cr_net_loss").alias("Returns_Loss"))
         .select(c("cc_call_center_id").alias("Call_Center"), c("cc_name").alias("Call_Center_Name"),
                 c("cc_manager").alias("Manager"), "Returns_Loss"))
    return order(g, ["-Returns_Loss"])


@register("q93")
def q93(spark, sf_dir, reason="Did not like the color"):
    """Left join to returns cancelled by the filter on the return's reason:
    an inner join (Catalyst removes the outer join)."""
    t = Tables(spark, sf_dir)
    c = F.col
    sr = (t.store_returns.select("sr_item_sk", "sr_ticket_number", "sr_reason_sk", "sr_return_quantity")
          .join(t.reason.filter(c("r_reason_desc") == reason).select("r_reason_sk"), c("sr_reason_sk") == c("r_reason_sk")))
    j = t.store_sales.select("ss_item_sk", "ss_ticket_number", "ss_customer_sk", "ss_quantity", "ss_sales_price").join(
        sr, (c("sr_item_sk") == c("ss_item_sk")) & (c("sr_ticket_number") == c("ss_ticket_number")))
    act = F.when(c("sr_return_quantity").isNotNull(), (c("ss_quantity") - c("sr_return_quantity")) * c("ss_sales_price")) \
        .otherwise(c("ss_quantity") * c("ss_sales_price"))
    g = j.groupBy("ss_customer_sk").agg(money_sum(act).alias("sumsales"))
    return topk(g, ["sumsales", "ss_customer_sk"])
