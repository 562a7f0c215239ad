"""Channel outlet reports: sales and returns per outlet, unioned across
channels and rolled up (channel, id).

Sales and returns are unioned with typed zero padding and aggregated
once per outlet; the rollup runs over that per-outlet aggregate (a few
thousand rows even at large scale), so its Expand is cheap.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.aggs import rollup_levels
from ...operators.joins import attach_scalar
from ...operators.sorts import topk
from ..registry import register
from .common import Tables

c = F.col


def Z():
    return F.lit(0).cast("decimal(7,2)")


def _window(t, start, days):
    d0 = F.lit(start).cast("date")
    return t.date_dim.filter(c("d_date").between(d0, F.date_add(d0, days))).select("d_date_sk")


def _channel_rollup(parts):
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    r = rollup_levels(u, ["channel", "id"], [F.sum("sales").cast("decimal(38,2)").alias("sales"),
                                             F.sum("returns").cast("decimal(38,2)").alias("returns"),
                                             F.sum("profit").cast("decimal(38,2)").alias("profit")], flags=False)
    return topk(r, ["channel", "id"])


@register("q05")
def q05(spark, sf_dir, start="1998-08-04", days=14):
    t = Tables(spark, sf_dir)
    dt = _window(t, start, days)

    def outlet(sales, rets, dim, dim_key, dim_id, label, prefix):
        u = sales.unionByName(rets)
        g = (u.join(dt, c("date_sk") == c("d_date_sk")).join(dim.select(dim_key, dim_id), c("outlet_sk") == c(dim_key))
             .groupBy(dim_id).agg(F.sum("sales_price").alias("sales"), F.sum("profit").alias("profit"),
                                  F.sum("return_amt").alias("returns"), F.sum("net_loss").alias("profit_loss")))
        return g.select(F.lit(label).alias("channel"), F.concat(F.lit(prefix), c(dim_id)).alias("id"),
                        "sales", "returns", (c("profit") - c("profit_loss")).alias("profit"))

    def sales_side(fact, p, outlet_col):
        return t.in_days(fact, f"{p}_sold_date_sk", dt).select(
            c(outlet_col).alias("outlet_sk"), c(f"{p}_sold_date_sk").alias("date_sk"),
            c(f"{p}_ext_sales_price").alias("sales_price"), c(f"{p}_net_profit").alias("profit"),
            Z().alias("return_amt"), Z().alias("net_loss"))

    def ret_side(df, outlet_col, date_col, amt, loss):
        return df.select(c(outlet_col).alias("outlet_sk"), c(date_col).alias("date_sk"), Z().alias("sales_price"),
                         Z().alias("profit"), c(amt).alias("return_amt"), c(loss).alias("net_loss"))

    ssr = outlet(sales_side(t.store_sales, "ss", "ss_store_sk"),
                 ret_side(t.in_days(t.store_returns, "sr_returned_date_sk", dt), "sr_store_sk", "sr_returned_date_sk", "sr_return_amt", "sr_net_loss"),
                 t.store, "s_store_sk", "s_store_id", "store channel", "store")
    csr = outlet(sales_side(t.catalog_sales, "cs", "cs_catalog_page_sk"),
                 ret_side(t.in_days(t.catalog_returns, "cr_returned_date_sk", dt), "cr_catalog_page_sk", "cr_returned_date_sk",
                          "cr_return_amount", "cr_net_loss"),
                 t.catalog_page, "cp_catalog_page_sk", "cp_catalog_page_id", "catalog channel", "catalog_page")
    # web returns carry no site: those of the days take it from the matching
    # sale (left join on item + order)
    days_only = dt.select(c("d_date_sk").alias("r_day"))
    wr = t.on_days(t.web_returns, "wr_returned_date_sk", days_only, "r_day").join(
        t.web_sales.select("ws_item_sk", "ws_order_number", "ws_web_site_sk"), (c("wr_item_sk") == c("ws_item_sk")) & (c("wr_order_number") == c("ws_order_number")), "left")
    wsr = outlet(sales_side(t.web_sales, "ws", "ws_web_site_sk"),
                 ret_side(wr, "ws_web_site_sk", "wr_returned_date_sk", "wr_return_amt", "wr_net_loss"),
                 t.web_site, "web_site_sk", "web_site_id", "web channel", "web_site")
    return _channel_rollup([ssr, csr, wsr])


@register("q77")
def q77(spark, sf_dir, start="1998-08-04", days=30):
    t = Tables(spark, sf_dir)
    dt = _window(t, start, days)

    def agg(fact, date_col, key, cols, dim=None, dim_key=None):
        j = fact.transform(t.on_days, date_col, dt)
        if dim is not None:
            j = j.join(dim.select(dim_key), c(key) == c(dim_key))
        return j.groupBy(c(key).alias("id")).agg(*[F.sum(v).alias(n) for v, n in cols])

    ss = agg(t.store_sales, "ss_sold_date_sk", "ss_store_sk", [("ss_ext_sales_price", "sales"), ("ss_net_profit", "profit")],
             t.store, "s_store_sk")
    sr = agg(t.store_returns, "sr_returned_date_sk", "sr_store_sk", [("sr_return_amt", "returns"), ("sr_net_loss", "loss")],
             t.store, "s_store_sk").withColumnRenamed("id", "rid")
    cs = agg(t.catalog_sales, "cs_sold_date_sk", "cs_call_center_sk",
             [("cs_ext_sales_price", "sales"), ("cs_net_profit", "profit")])
    # keyless aggregate: exactly one row, placed beside every call-centre row
    cr = (t.catalog_returns.transform(t.on_days, "cr_returned_date_sk", dt)
          .agg(F.sum("cr_return_amount").alias("returns"), F.sum("cr_net_loss").alias("loss")))
    ws = agg(t.web_sales, "ws_sold_date_sk", "ws_web_page_sk", [("ws_ext_sales_price", "sales"), ("ws_net_profit", "profit")],
             t.web_page, "wp_web_page_sk")
    wr = agg(t.web_returns, "wr_returned_date_sk", "wr_web_page_sk", [("wr_return_amt", "returns"), ("wr_net_loss", "loss")],
             t.web_page, "wp_web_page_sk").withColumnRenamed("id", "rid")

    def left(a, b, label):
        j = a.join(b, c("id") == c("rid"), "left")
        return j.select(F.lit(label).alias("channel"), "id", "sales", F.coalesce(c("returns"), F.lit(0)).alias("returns"),
                        (c("profit") - F.coalesce(c("loss"), F.lit(0))).alias("profit"))
    cat = attach_scalar(cs, cr).select(F.lit("catalog channel").alias("channel"), "id", "sales", "returns",
                                       (c("profit") - c("loss")).alias("profit"))
    return _channel_rollup([left(ss, sr, "store channel"), cat, left(ws, wr, "web channel")])


@register("q80")
def q80(spark, sf_dir, start="1998-08-04", days=30, min_price=50):
    """Promotion-free channel sales net of returns.  The left join to returns
    is on (item, ticket/order), the sale's own keys, so it never fans out."""
    t = Tables(spark, sf_dir)
    dt = _window(t, start, days)
    it = t.item.filter(c("i_current_price") > min_price).select("i_item_sk")
    pr = t.promotion.filter(c("p_channel_tv") == "N").select("p_promo_sk")

    def chan(sales, p, num, rets, r, rnum, amt, dim, dim_key, dim_id, outlet_col, label, prefix):
        rr = rets.select(c(f"{r}_item_sk").alias("r_item"), c(f"{r}_{rnum}").alias("r_num"),
                         c(f"{r}_{amt}").alias("r_amt"), c(f"{r}_net_loss").alias("r_loss"))
        j = (sales.transform(t.on_days, f"{p}_sold_date_sk", dt)
             .join(dim.select(dim_key, dim_id), c(outlet_col) == c(dim_key))
             .join(it, c(f"{p}_item_sk") == c("i_item_sk"))
             .join(pr, c(f"{p}_promo_sk") == c("p_promo_sk"))
             .join(rr, (c(f"{p}_item_sk") == c("r_item")) & (c(f"{p}_{num}") == c("r_num")), "left"))
        g = j.groupBy(dim_id).agg(F.sum(f"{p}_ext_sales_price").alias("sales"),
                                  F.sum(F.coalesce(c("r_amt"), F.lit(0))).alias("returns"),
                                  F.sum(c(f"{p}_net_profit") - F.coalesce(c("r_loss"), F.lit(0))).alias("profit"))
        return g.select(F.lit(label).alias("channel"), F.concat(F.lit(prefix), c(dim_id)).alias("id"),
                        "sales", "returns", "profit")
    return _channel_rollup([
        chan(t.store_sales, "ss", "ticket_number", t.store_returns, "sr", "ticket_number", "return_amt",
             t.store, "s_store_sk", "s_store_id", "ss_store_sk", "store channel", "store"),
        chan(t.catalog_sales, "cs", "order_number", t.catalog_returns, "cr", "order_number", "return_amount",
             t.catalog_page, "cp_catalog_page_sk", "cp_catalog_page_id", "cs_catalog_page_sk", "catalog channel",
             "catalog_page"),
        chan(t.web_sales, "ws", "order_number", t.web_returns, "wr", "order_number", "return_amt",
             t.web_site, "web_site_sk", "web_site_id", "ws_web_site_sk", "web channel", "web_site")])


@register("q76")
def q76(spark, sf_dir):
    """Sales with a missing key, per channel: IS NULL filters pushed into the
    fact scans, union of the three, one aggregate."""
    t = Tables(spark, sf_dir)
    d = t.date_dim.select("d_date_sk", "d_year", "d_qoy")
    it = t.item.select("i_item_sk", "i_category")
    parts = []
    for label, col_name, fact, p in (("store", "ss_addr_sk", t.store_sales, "ss"),
                                     ("web", "ws_web_page_sk", t.web_sales, "ws"),
                                     ("catalog", "cs_warehouse_sk", t.catalog_sales, "cs")):
        parts.append(fact.filter(c(col_name).isNull())
                     .transform(t.on_days, f"{p}_sold_date_sk", d).join(it, c(f"{p}_item_sk") == c("i_item_sk"))
                     .select(F.lit(label).alias("channel"), F.lit(col_name).alias("col_name"), "d_year", "d_qoy",
                             "i_category", c(f"{p}_ext_sales_price").alias("ext_sales_price")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    keys = ["channel", "col_name", "d_year", "d_qoy", "i_category"]
    g = u.groupBy(*keys).agg(F.count(F.lit(1)).alias("sales_cnt"),
                             F.sum("ext_sales_price").cast("decimal(38,2)").alias("sales_amt"))
    return topk(g, keys)


@register("q78")
def q78(spark, sf_dir, year=2000):
    """Unreturned store sales against the other channels.

    ``LEFT JOIN returns .. WHERE returns.key IS NULL`` keeps the sales of the
    year that have no return, so the returns meet one year only.  The text joins the catalog aggregate on (year,
    customer) only (its item condition compares a column with itself), so
    every store row meets every catalog row of the same customer and year.
    The output is ordered by the store row's own unique keys first, so only
    the first 100 qualifying store rows can appear: they are selected with a
    bounded top-k, and only those are expanded against the catalog rows."""
    from ...functions.scalars import int_div
    from ...operators.joins import without
    from ...operators.sorts import asc, desc
    t = Tables(spark, sf_dir)
    # the joins on the year leave this one alone
    d = t.date_dim.filter(c("d_year") == year).select("d_date_sk", "d_year")

    def unreturned(sales, p, num, rets, rnum, r, cust, name):
        s = without(sales.transform(t.on_days, f"{p}_sold_date_sk", d), rets,
                    [f"{p}_{num}", f"{p}_item_sk"], [f"{r}_{rnum}", f"{r}_item_sk"])
        return (s.groupBy(c("d_year").alias(f"{name}_sold_year"), c(f"{p}_item_sk").alias(f"{name}_item_sk"),
                         c(cust).alias(f"{name}_customer_sk"))
                .agg(F.sum(f"{p}_quantity").alias(f"{name}_qty"), F.sum(f"{p}_wholesale_cost").alias(f"{name}_wc"),
                     F.sum(f"{p}_sales_price").alias(f"{name}_sp")))
    ws = unreturned(t.web_sales, "ws", "order_number", t.web_returns, "order_number", "wr", "ws_bill_customer_sk", "ws")
    cs = unreturned(t.catalog_sales, "cs", "order_number", t.catalog_returns, "order_number", "cr",
                    "cs_bill_customer_sk", "cs")
    ss = unreturned(t.store_sales, "ss", "ticket_number", t.store_returns, "ticket_number", "sr", "ss_customer_sk", "ss")
    j = ss.join(ws, (c("ws_sold_year") == c("ss_sold_year")) & (c("ws_item_sk") == c("ss_item_sk"))
                & (c("ws_customer_sk") == c("ss_customer_sk"))).filter(c("ws_qty") > 0)
    cs_keys = cs.filter(c("cs_item_sk").isNotNull() & (c("cs_qty") > 0)).select(
        c("cs_sold_year").alias("k_year"), c("cs_customer_sk").alias("k_cust")).distinct()
    j = j.join(cs_keys, (c("k_year") == c("ss_sold_year")) & (c("k_cust") == c("ss_customer_sk")), "left_semi")
    first = j.orderBy(asc("ss_sold_year"), asc("ss_item_sk"), asc("ss_customer_sk")).limit(100)
    x = first.join(cs.filter(c("cs_item_sk").isNotNull()),
                   (c("cs_sold_year") == c("ss_sold_year")) & (c("cs_customer_sk") == c("ss_customer_sk")))
    x = x.filter(F.coalesce(c("cs_qty"), F.lit(0)) > 0)
    other_qty = F.coalesce(c("ws_qty"), F.lit(0)) + F.coalesce(c("cs_qty"), F.lit(0))
    out = x.select("ss_sold_year", "ss_item_sk", "ss_customer_sk",
                   F.round(int_div(c("ss_qty"), F.coalesce(c("ws_qty") + c("cs_qty"), F.lit(1))), 2).alias("ratio"),
                   c("ss_qty").cast("bigint").alias("store_qty"), c("ss_wc").cast("decimal(38,2)").alias("store_wholesale_cost"),
                   c("ss_sp").cast("decimal(38,2)").alias("store_sales_price"), other_qty.cast("bigint").alias("other_chan_qty"),
                   (F.coalesce(c("ws_wc"), F.lit(0)) + F.coalesce(c("cs_wc"), F.lit(0))).cast("decimal(38,2)")
                   .alias("other_chan_wholesale_cost"),
                   (F.coalesce(c("ws_sp"), F.lit(0)) + F.coalesce(c("cs_sp"), F.lit(0))).cast("decimal(38,2)")
                   .alias("other_chan_sales_price"))
    return topk(out, ["ss_sold_year", "ss_item_sk", "ss_customer_sk", desc("store_qty"), desc("store_wholesale_cost"),
                      desc("store_sales_price"), "other_chan_qty", "other_chan_wholesale_cost", "other_chan_sales_price",
                      "ratio"])
