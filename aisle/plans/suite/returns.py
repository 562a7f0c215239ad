"""Sale -> return -> re-purchase chains (q17 q25 q29) and inventory checks
(q37 q82).

The chain joins a store sale to its return on (customer, item, ticket) and
then to *every* catalog sale of the same (customer, item).  Written
literally that is a many-to-many join whose output is only summed.  Here
the catalog side is first reduced to one row per (customer, item) holding
its count, sum and sum of squares; each returned sale then meets one row,
and the aggregates are rebuilt exactly from those moments (a row repeated
n times contributes n, n*x and n*x^2).  Same results, no fan-out, however
many purchases one customer makes of one item.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import avg4, mean, quotient4, r4
from ...operators.joins import semi
from ...operators.sorts import topk
from ..registry import register
from .common import Tables

c = F.col


def _chain(t, d1, d2, d3, cs_value):
    ss = t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_store_sk", "ss_customer_sk", "ss_ticket_number",
                              "ss_quantity", "ss_net_profit").transform(t.on_days, "ss_sold_date_sk", d1, "d1_sk")
    sr = t.store_returns.select("sr_returned_date_sk", "sr_customer_sk", "sr_item_sk", "sr_ticket_number",
                                "sr_return_quantity", "sr_net_loss").transform(t.on_days, "sr_returned_date_sk", d2, "d2_sk")
    cs = (t.catalog_sales.select("cs_sold_date_sk", "cs_bill_customer_sk", "cs_item_sk", cs_value)
          .transform(t.on_days, "cs_sold_date_sk", d3, "d3_sk")
          .groupBy("cs_bill_customer_sk", "cs_item_sk")
          .agg(F.count(F.lit(1)).alias("cs_n"), F.count(cs_value).alias("cs_cnt"), F.sum(cs_value).alias("cs_sum"),
               F.sum(c(cs_value) * c(cs_value)).alias("cs_sumsq")))
    j = (ss.join(sr, (c("ss_customer_sk") == c("sr_customer_sk")) & (c("ss_item_sk") == c("sr_item_sk"))
                 & (c("ss_ticket_number") == c("sr_ticket_number")))
         .join(cs, (c("sr_customer_sk") == c("cs_bill_customer_sk")) & (c("sr_item_sk") == c("cs_item_sk"))))
    return (j.join(t.item.select("i_item_sk", "i_item_id", "i_item_desc"), c("i_item_sk") == c("ss_item_sk"))
            .join(t.store.select("s_store_sk", "s_store_id", "s_store_name", "s_state"), c("s_store_sk") == c("ss_store_sk")))


def _d(t, cond, name):
    return t.date_dim.filter(cond).select(c("d_date_sk").alias(name))


@register("q25")
def q25(spark, sf_dir, year=2000, moy=4, moy_hi=10):
    t = Tables(spark, sf_dir)
    y, m = c("d_year"), c("d_moy")
    j = _chain(t, _d(t, (m == moy) & (y == year), "d1_sk"), _d(t, m.between(moy, moy_hi) & (y == year), "d2_sk"),
               _d(t, m.between(moy, moy_hi) & (y == year), "d3_sk"), "cs_net_profit")
    keys = ["i_item_id", "i_item_desc", "s_store_id", "s_store_name"]
    g = j.groupBy(*keys).agg(F.sum(c("ss_net_profit") * c("cs_n")).cast("decimal(38,2)").alias("store_sales_profit"),
                             F.sum(c("sr_net_loss") * c("cs_n")).cast("decimal(38,2)").alias("store_returns_loss"),
                             F.sum("cs_sum").cast("decimal(38,2)").alias("catalog_sales_profit"))
    return topk(g, keys)


@register("q29")
def q29(spark, sf_dir, year=1999, moy=4):
    t = Tables(spark, sf_dir)
    y, m = c("d_year"), c("d_moy")
    j = _chain(t, _d(t, (m == moy) & (y == year), "d1_sk"), _d(t, m.between(moy, moy + 3) & (y == year), "d2_sk"),
               _d(t, y.isin(year, year + 1, year + 2), "d3_sk"), "cs_quantity")
    keys = ["i_item_id", "i_item_desc", "s_store_id", "s_store_name"]
    g = j.groupBy(*keys).agg(F.sum(c("ss_quantity") * c("cs_n")).cast("bigint").alias("store_sales_quantity"),
                             F.sum(c("sr_return_quantity") * c("cs_n")).cast("bigint").alias("store_returns_quantity"),
                             F.sum("cs_sum").cast("bigint").alias("catalog_sales_quantity"))
    return topk(g, keys)


def _moments(n, s, ss, prefix):
    """count, avg, stddev_samp and cov from exact integer moments."""
    nd = n.cast("double")
    var = (n * ss - s * s).cast("double") / (nd * (nd - 1))
    sd = F.when(n > 1, F.sqrt(var))
    avg = s.cast("double") / nd
    return n, avg, sd, sd / avg


@register("q17")
def q17(spark, sf_dir, quarter="2000Q1", quarters=("2000Q1", "2000Q2", "2000Q3")):
    """Count, mean and sample deviation of the three quantities.  The text
    labels a ratio as a deviation for the catalog side (kept)."""
    t = Tables(spark, sf_dir)
    q = c("d_quarter_name")
    j = _chain(t, _d(t, q == quarter, "d1_sk"), _d(t, q.isin(list(quarters)), "d2_sk"),
               _d(t, q.isin(list(quarters)), "d3_sk"), "cs_quantity")
    keys = ["i_item_id", "i_item_desc", "s_state"]
    g = j.groupBy(*keys).agg(
        F.sum("cs_n").alias("n"),
        F.sum(c("ss_quantity") * c("cs_n")).alias("s1"), F.sum(c("ss_quantity") * c("ss_quantity") * c("cs_n")).alias("q1"),
        F.sum(c("sr_return_quantity") * c("cs_n")).alias("s2"),
        F.sum(c("sr_return_quantity") * c("sr_return_quantity") * c("cs_n")).alias("q2"),
        F.sum("cs_cnt").alias("n3"), F.sum("cs_sum").alias("s3"), F.sum("cs_sumsq").alias("q3"))
    n1, a1, d1, v1 = _moments(c("n"), c("s1"), c("q1"), "ss")
    n2, a2, d2, v2 = _moments(c("n"), c("s2"), c("q2"), "sr")
    n3, a3, d3, v3 = _moments(c("n3"), c("s3"), c("q3"), "cs")
    out = g.select(*keys,
                   n1.cast("bigint").alias("store_sales_quantitycount"), quotient4(c("s1"), c("n")).alias("store_sales_quantityave"),
                   r4(d1).alias("store_sales_quantitystdev"), r4(v1).alias("store_sales_quantitycov"),
                   n2.cast("bigint").alias("as_store_returns_quantitycount"), quotient4(c("s2"), c("n")).alias("as_store_returns_quantityave"),
                   r4(d2).alias("as_store_returns_quantitystdev"), r4(v2).alias("store_returns_quantitycov"),
                   n3.cast("bigint").alias("catalog_sales_quantitycount"), quotient4(c("s3"), c("n3")).alias("catalog_sales_quantityave"),
                   r4(v3).alias("catalog_sales_quantitystdev"), r4(v3).alias("catalog_sales_quantitycov"))
    return topk(out, keys)


def _in_stock(t, fact, item_col, lo_price, start, manufacts):
    """Items in a price band with 100..500 on hand in a 60-day window and
    at least one sale: semi joins on distinct keys (the text's join plus
    GROUP BY returns each item once)."""
    d0 = F.lit(start).cast("date")
    d = t.date_dim.filter(c("d_date").between(d0, F.date_add(d0, 60))).select("d_date_sk")
    inv = t.inventory.filter(c("inv_quantity_on_hand").between(100, 500)).transform(t.on_days, "inv_date_sk", d)
    it = t.item.filter(c("i_current_price").between(lo_price, lo_price + 30) & c("i_manufact_id").isin(list(manufacts)))
    it = semi(it, inv, ["i_item_sk"], ["inv_item_sk"])
    it = semi(it, fact.select(item_col), ["i_item_sk"], [item_col])
    g = it.select("i_item_id", "i_item_desc", "i_current_price").distinct()
    return topk(g, ["i_item_id"])


@register("q37")
def q37(spark, sf_dir, lo_price=22, start="2000-06-02", manufacts=(12, 29, 35, 48)):
    t = Tables(spark, sf_dir)
    return _in_stock(t, t.catalog_sales, "cs_item_sk", lo_price, start, manufacts)


@register("q82")
def q82(spark, sf_dir, lo_price=30, start="2000-05-30", manufacts=(7, 22, 33, 41)):
    t = Tables(spark, sf_dir)
    return _in_stock(t, t.store_sales, "ss_item_sk", lo_price, start, manufacts)


@register("q21")
def q21(spark, sf_dir, day="2000-04-12", lo_price=0.99, hi_price=30.00):
    """Stock before / after a date; the ratio of the two integer sums uses
    integer division, as in the suite's dialect (kept)."""
    from ...functions.scalars import int_div
    t = Tables(spark, sf_dir)
    d0 = F.lit(day).cast("date")
    d = t.date_dim.filter(c("d_date").between(F.date_sub(d0, 30), F.date_add(d0, 30))).select("d_date_sk", "d_date")
    it = t.item.filter(c("i_current_price").between(lo_price, hi_price)).select("i_item_sk", "i_item_id")
    j = (t.inventory.transform(t.on_days, "inv_date_sk", d).join(it, c("i_item_sk") == c("inv_item_sk"))
         .join(t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), c("inv_warehouse_sk") == c("w_warehouse_sk")))
    q = c("inv_quantity_on_hand")
    g = j.groupBy("w_warehouse_name", "i_item_id").agg(
        F.sum(F.when(c("d_date") < d0, q).otherwise(0)).cast("bigint").alias("inv_before"),
        F.sum(F.when(c("d_date") >= d0, q).otherwise(0)).cast("bigint").alias("inv_after"))
    ratio = F.when(c("inv_before") > 0, int_div(c("inv_after"), c("inv_before")))
    g = g.filter(ratio.between(2.0 / 3.0, 3.0 / 2.0))
    return topk(g, ["w_warehouse_name", "i_item_id"])


def _inv_pairs(t, year, moy, min_cov1):
    """q39: month ``moy`` and ``moy + 1`` statistics per (warehouse, item).
    The text self-joins the monthly statistics; here both months come from
    one conditional aggregation keyed by (warehouse, item)."""
    d = t.date_dim.filter((c("d_year") == year) & c("d_moy").isin(moy, moy + 1)).select("d_date_sk", "d_moy")
    j = (t.inventory.transform(t.on_days, "inv_date_sk", d)
         .join(t.item.select("i_item_sk"), c("inv_item_sk") == c("i_item_sk"))
         .join(t.warehouse.select("w_warehouse_sk"), c("inv_warehouse_sk") == c("w_warehouse_sk")))
    q = c("inv_quantity_on_hand")
    aggs = []
    for i, m in ((1, moy), (2, moy + 1)):
        v = F.when(c("d_moy") == m, q)
        aggs += [F.stddev_samp(v).alias(f"sd{i}"), mean(v).alias(f"mean{i}"), avg4(v).alias(f"shown{i}"), F.count(v).alias(f"n{i}")]
    g = j.groupBy("w_warehouse_sk", "i_item_sk").agg(*aggs)
    for i in (1, 2):
        cov = F.when(c(f"mean{i}") == 0, F.lit(None)).otherwise(c(f"sd{i}") / c(f"mean{i}"))
        g = g.withColumn(f"cov{i}", cov).filter((c(f"n{i}") > 0) & (
            F.when(c(f"mean{i}") == 0, F.lit(0.0)).otherwise(c(f"sd{i}") / c(f"mean{i}")) > 1))
    if min_cov1 is not None:
        g = g.filter(c("cov1") > min_cov1)
    out = g.select(c("w_warehouse_sk").alias("w_warehouse_sk1"), c("i_item_sk").alias("i_item_sk1"),
                   F.lit(moy).alias("d_moy1"), c("shown1").alias("mean1"), r4("cov1").alias("cov1"),
                   c("w_warehouse_sk").alias("w_warehouse_sk2"), c("i_item_sk").alias("i_item_sk2"),
                   F.lit(moy + 1).alias("d_moy2"), c("shown2").alias("mean2"), r4("cov2").alias("cov2"))
    from ...operators.sorts import order
    return order(out, ["w_warehouse_sk1", "i_item_sk1", "d_moy1", "mean1", "cov1", "d_moy2", "mean2", "cov2"])


@register("q39a")
def q39a(spark, sf_dir, year=2000, moy=1):
    return _inv_pairs(Tables(spark, sf_dir), year, moy, None)


@register("q39b")
def q39b(spark, sf_dir, year=2000, moy=1, min_cov=1.5):
    return _inv_pairs(Tables(spark, sf_dir), year, moy, min_cov)


@register("q40")
def q40(spark, sf_dir, day="1998-04-08", lo_price=0.99, hi_price=30.00):
    t = Tables(spark, sf_dir)
    d0 = F.lit(day).cast("date")
    d = t.date_dim.filter(c("d_date").between(F.date_sub(d0, 30), F.date_add(d0, 30))).select("d_date_sk", "d_date")
    cr = t.catalog_returns.select(c("cr_order_number").alias("r_ord"), c("cr_item_sk").alias("r_item"),
                                  "cr_refunded_cash")
    j = (t.catalog_sales.select("cs_order_number", "cs_item_sk", "cs_warehouse_sk", "cs_sold_date_sk", "cs_sales_price")
         .transform(t.on_days, "cs_sold_date_sk", d)
         .join(t.warehouse.select("w_warehouse_sk", "w_state"), c("cs_warehouse_sk") == c("w_warehouse_sk"))
         .join(t.item.filter(c("i_current_price").between(lo_price, hi_price)).select("i_item_sk", "i_item_id"),
               c("i_item_sk") == c("cs_item_sk"))
         .join(cr, (c("cs_order_number") == c("r_ord")) & (c("cs_item_sk") == c("r_item")), "left"))
    net = c("cs_sales_price") - F.coalesce(c("cr_refunded_cash"), F.lit(0))
    g = j.groupBy("w_state", "i_item_id").agg(
        F.sum(F.when(c("d_date") < d0, net).otherwise(0)).cast("decimal(38,2)").alias("sales_before"),
        F.sum(F.when(c("d_date") >= d0, net).otherwise(0)).cast("decimal(38,2)").alias("sales_after"))
    return topk(g, ["w_state", "i_item_id"])


@register("q85")
def q85(spark, sf_dir, year=1998, m1="M", e1="4 yr Degree", m2="D", e2="Primary", m3="U", e3="Advanced Degree",
        states1=("KY", "GA", "NM"), states2=("TN", "OH", "IN"), states3=("WA", "CA", "TX")):
    """Web returns by reason over OR-ed demographic and address bands; the
    shared join keys of every OR branch are factored out into the joins."""
    t = Tables(spark, sf_dir)
    cd1 = t.customer_demographics.select(c("cd_demo_sk").alias("cd1_sk"), c("cd_marital_status").alias("m1"),
                                         c("cd_education_status").alias("e1"))
    cd2 = t.customer_demographics.select(c("cd_demo_sk").alias("cd2_sk"), c("cd_marital_status").alias("m2"),
                                         c("cd_education_status").alias("e2"))
    j = (t.web_sales.select("ws_web_page_sk", "ws_item_sk", "ws_order_number", "ws_sold_date_sk", "ws_quantity",
                            "ws_sales_price", "ws_net_profit")
         .transform(t.on_days, "ws_sold_date_sk", t.date_dim.filter(c("d_year") == year).select("d_date_sk"))
         .join(t.web_returns.select("wr_item_sk", "wr_order_number", "wr_refunded_cdemo_sk", "wr_returning_cdemo_sk",
                                    "wr_refunded_addr_sk", "wr_reason_sk", "wr_refunded_cash", "wr_fee"),
               (c("ws_item_sk") == c("wr_item_sk")) & (c("ws_order_number") == c("wr_order_number")))
         .join(t.web_page.select("wp_web_page_sk"), c("ws_web_page_sk") == c("wp_web_page_sk"))
         .join(cd1, c("cd1_sk") == c("wr_refunded_cdemo_sk")).join(cd2, c("cd2_sk") == c("wr_returning_cdemo_sk"))
         .join(t.customer_address.select("ca_address_sk", "ca_country", "ca_state"), c("ca_address_sk") == c("wr_refunded_addr_sk"))
         .join(t.reason.select("r_reason_sk", "r_reason_desc"), c("r_reason_sk") == c("wr_reason_sk")))
    demo = None
    for m, e, lo, hi in ((m1, e1, 100, 150), (m2, e2, 50, 100), (m3, e3, 150, 200)):
        x = ((c("m1") == m) & (c("m1") == c("m2")) & (c("e1") == e) & (c("e1") == c("e2"))
             & c("ws_sales_price").between(lo, hi))
        demo = x if demo is None else demo | x
    addr = None
    for states, lo, hi in ((states1, 0, 2000), (states2, 150, 3000), (states3, 50, 25000)):
        x = (c("ca_country") == "United States") & c("ca_state").isin(list(states)) & c("ws_net_profit").between(lo, hi)
        addr = x if addr is None else addr | x
    g = j.filter(demo & addr).groupBy("r_reason_desc").agg(
        avg4("ws_quantity").alias("avg_qty"), avg4("wr_refunded_cash").alias("avg_cash"),
        avg4("wr_fee").alias("avg_fee"))
    out = g.select(F.substring("r_reason_desc", 1, 20).alias("reason20"), "avg_qty", "avg_cash", "avg_fee")
    return topk(out, ["reason20", "avg_qty", "avg_cash", "avg_fee"])


@register("q64")
def q64(spark, sf_dir, colors=("purple", "burlywood", "indian", "spring", "floral", "medium", "pale", "chiffon",
                               "blanched", "burnished", "slate", "aquamarine"), price=35, year=1997):
    """Store sales of returned items, by item, store and both addresses, this
    year against next year.  ``cs_ui`` (items whose catalog list sales
    exceed twice their refunds) is a semi-join filter on the item.  The
    final self-join pairs the groups of one (item, store) across the two
    years; its output is exactly those pairs."""
    t = Tables(spark, sf_dir)
    cs_ui = (t.catalog_sales.select("cs_item_sk", "cs_order_number", "cs_ext_list_price")
             .join(t.catalog_returns.select("cr_item_sk", "cr_order_number", "cr_refunded_cash", "cr_reversed_charge",
                                            "cr_store_credit"),
                   (c("cs_item_sk") == c("cr_item_sk")) & (c("cs_order_number") == c("cr_order_number")))
             .groupBy("cs_item_sk")
             .agg(F.sum("cs_ext_list_price").alias("sale"),
                  F.sum(c("cr_refunded_cash") + c("cr_reversed_charge") + c("cr_store_credit")).alias("refund"))
             .filter(c("sale") > 2 * c("refund")).select(c("cs_item_sk").alias("ui_item")))
    it = t.item.filter(c("i_color").isin(list(colors)) & c("i_current_price").between(price, price + 10)
                       & c("i_current_price").between(price + 1, price + 15)).select("i_item_sk", "i_product_name")
    cd1 = t.customer_demographics.select(c("cd_demo_sk").alias("cd1_sk"), c("cd_marital_status").alias("ms1"))
    cd2 = t.customer_demographics.select(c("cd_demo_sk").alias("cd2_sk"), c("cd_marital_status").alias("ms2"))
    hd1 = t.household_demographics.select(c("hd_demo_sk").alias("hd1_sk"), c("hd_income_band_sk").alias("ib1"))
    hd2 = t.household_demographics.select(c("hd_demo_sk").alias("hd2_sk"), c("hd_income_band_sk").alias("ib2"))
    ib1 = t.income_band.select(c("ib_income_band_sk").alias("ib1_sk"))
    ib2 = t.income_band.select(c("ib_income_band_sk").alias("ib2_sk"))
    a1 = t.customer_address.select(c("ca_address_sk").alias("a1_sk"), c("ca_street_number").alias("b_street_number"),
                                   c("ca_street_name").alias("b_streen_name"), c("ca_city").alias("b_city"),
                                   c("ca_zip").alias("b_zip"))
    a2 = t.customer_address.select(c("ca_address_sk").alias("a2_sk"), c("ca_street_number").alias("c_street_number"),
                                   c("ca_street_name").alias("c_street_name"), c("ca_city").alias("c_city"),
                                   c("ca_zip").alias("c_zip"))
    d1 = t.date_dim.filter(c("d_year").isin(year, year + 1)).select(c("d_date_sk").alias("d1_sk"), c("d_year").alias("syear"))
    d2 = t.date_dim.select(c("d_date_sk").alias("d2_sk"), c("d_year").alias("fsyear"))
    d3 = t.date_dim.select(c("d_date_sk").alias("d3_sk"), c("d_year").alias("s2year"))
    j = (t.store_sales.select("ss_item_sk", "ss_ticket_number", "ss_store_sk", "ss_sold_date_sk", "ss_customer_sk",
                              "ss_cdemo_sk", "ss_hdemo_sk", "ss_addr_sk", "ss_promo_sk", "ss_wholesale_cost",
                              "ss_list_price", "ss_coupon_amt")
         .transform(t.on_days, "ss_sold_date_sk", d1, "d1_sk")
         .join(it, c("ss_item_sk") == c("i_item_sk"))
         .join(t.store_returns.select("sr_item_sk", "sr_ticket_number"),
               (c("ss_item_sk") == c("sr_item_sk")) & (c("ss_ticket_number") == c("sr_ticket_number")))
         .join(cs_ui, c("ss_item_sk") == c("ui_item"))  # one row per item; a semi join would be moved below the returns
         .join(t.store.select("s_store_sk", "s_store_name", "s_zip"), c("ss_store_sk") == c("s_store_sk"))
         .join(t.customer.select("c_customer_sk", "c_current_cdemo_sk", "c_current_hdemo_sk", "c_current_addr_sk",
                                 "c_first_sales_date_sk", "c_first_shipto_date_sk"), c("ss_customer_sk") == c("c_customer_sk"))
         .join(cd1, c("ss_cdemo_sk") == c("cd1_sk")).join(cd2, c("c_current_cdemo_sk") == c("cd2_sk"))
         .filter(c("ms1") != c("ms2"))
         .join(t.promotion.select("p_promo_sk"), c("ss_promo_sk") == c("p_promo_sk"))
         .join(hd1, c("ss_hdemo_sk") == c("hd1_sk")).join(hd2, c("c_current_hdemo_sk") == c("hd2_sk"))
         .join(ib1, c("ib1") == c("ib1_sk")).join(ib2, c("ib2") == c("ib2_sk"))
         .join(a1, c("ss_addr_sk") == c("a1_sk")).join(a2, c("c_current_addr_sk") == c("a2_sk"))
         .join(d2, c("c_first_sales_date_sk") == c("d2_sk")).join(d3, c("c_first_shipto_date_sk") == c("d3_sk")))
    keys = ["i_product_name", "i_item_sk", "s_store_name", "s_zip", "b_street_number", "b_streen_name", "b_city", "b_zip",
            "c_street_number", "c_street_name", "c_city", "c_zip", "syear", "fsyear", "s2year"]
    cross = j.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"), F.sum("ss_wholesale_cost").alias("s1"),
                                 F.sum("ss_list_price").alias("s2"), F.sum("ss_coupon_amt").alias("s3"))
    cs1 = cross.filter(c("syear") == year)
    cs2 = cross.filter(c("syear") == year + 1).select(
        c("i_item_sk").alias("item2"), c("s_store_name").alias("store2"), c("s_zip").alias("zip2"),
        c("s1").alias("s1_2"), c("s2").alias("s2_2"), c("s3").alias("s3_2"), c("syear").alias("syear_2"),
        c("cnt").alias("cnt_2"))
    pj = cs1.join(cs2, (c("i_item_sk") == c("item2")) & (c("cnt_2") <= c("cnt")) & (c("s_store_name") == c("store2"))
                  & (c("s_zip") == c("zip2")))
    m = "decimal(38,2)"
    out = pj.select(c("i_product_name").alias("product_name"), c("s_store_name").alias("store_name"),
                    c("s_zip").alias("store_zip"), "b_street_number", "b_streen_name", "b_city", "b_zip",
                    "c_street_number", "c_street_name", "c_city", "c_zip", "syear", "cnt",
                    *[c(x).cast(m).alias(x) for x in ("s1", "s2", "s3", "s1_2", "s2_2", "s3_2")], "syear_2", "cnt_2")
    from ...operators.sorts import order
    return order(out, ["product_name", "store_name", "cnt_2"])
