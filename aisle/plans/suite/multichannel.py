"""Orders, items and customers seen across channels: EXISTS with a
residual, NOT EXISTS, IN under OR, and three-channel item matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import quotient4
from ...operators.joins import not_exists, semi, with_flag, without
from ...operators.sorts import topk
from ..registry import register
from .common import Tables

c = F.col


def _ship_window(t, start, days=60):
    d0 = F.lit(start).cast("date")
    return t.date_dim.filter(c("d_date").between(d0, F.date_add(d0, days))).select("d_date_sk")


def _multi_wh_totals(t, sales, p, outlet, outlet_key, state, start, rets_orders, exists_mode):
    """Q16 / Q94 / Q95 body.  The date, address and outlet filters come first;
    only the orders that are left meet the whole fact, and "shipped from
    another warehouse" is decided per order from the min and max warehouse,
    never by pairing the order's lines.  These sets have one row per order
    and are inner joins, which the optimizer leaves where they are."""
    order = f"{p}_order_number"
    s = (sales.select(order, f"{p}_warehouse_sk", f"{p}_ship_date_sk", f"{p}_ship_addr_sk",
                      outlet_key, f"{p}_ext_ship_cost", f"{p}_net_profit")
         .join(_ship_window(t, start), c(f"{p}_ship_date_sk") == c("d_date_sk"))
         .join(t.customer_address.filter(c("ca_state") == state).select("ca_address_sk"),
               c(f"{p}_ship_addr_sk") == c("ca_address_sk"))
         .join(outlet, c(outlet_key) == c(outlet.columns[0])))
    orders = s.select(c(order).alias("o1")).distinct()
    spread = (sales.select(c(order).alias("o2"), c(f"{p}_warehouse_sk").alias("w2")).join(orders, c("o1") == c("o2"))
              .groupBy("o2").agg(F.min("w2").alias("mn"), F.max("w2").alias("mx")))
    if exists_mode == "exists":
        s = s.join(spread, c(order) == c("o2")).filter((c("mn") != c(f"{p}_warehouse_sk")) | (c("mx") != c(f"{p}_warehouse_sk")))
        s = without(s, rets_orders, [order], ["r_order"])
    else:
        multi = spread.filter(c("mn") != c("mx")).select(c("o2").alias("m_order"))
        returned = rets_orders.join(multi, c("r_order") == c("m_order")).select("r_order").distinct()
        s = s.join(returned, c(order) == c("r_order"))
    return s.agg(F.count_distinct(f"{p}_order_number").alias("order count"),
                 F.sum(f"{p}_ext_ship_cost").cast("decimal(38,2)").alias("total shipping cost"),
                 F.sum(f"{p}_net_profit").cast("decimal(38,2)").alias("total net profit")).limit(100)


@register("q16")
def q16(spark, sf_dir, start="1999-2-01", state="IL",
        counties=("Fairfield County", "Fairfield County", "Fairfield County", "Bronx County", "Luce County")):
    t = Tables(spark, sf_dir)
    cc = t.call_center.filter(c("cc_county").isin(list(counties))).select("cc_call_center_sk")
    rets = t.catalog_returns.select(c("cr_order_number").alias("r_order"))
    return _multi_wh_totals(t, t.catalog_sales, "cs", cc, "cs_call_center_sk", state, start, rets, "exists")


@register("q94")
def q94(spark, sf_dir, start="1999-5-01", state="TN", company="pri"):
    t = Tables(spark, sf_dir)
    ws = t.web_site.filter(c("web_company_name") == company).select("web_site_sk")
    rets = t.web_returns.select(c("wr_order_number").alias("r_order"))
    return _multi_wh_totals(t, t.web_sales, "ws", ws, "ws_web_site_sk", state, start, rets, "exists")


@register("q95")
def q95(spark, sf_dir, start="1999-5-01", state="TX", company="pri"):
    """The CTE of warehouse pairs is replaced by the set of orders shipped
    from two or more warehouses (min <> max per order): the same IN sets,
    without materialising every pair of lines of an order."""
    t = Tables(spark, sf_dir)
    ws = t.web_site.filter(c("web_company_name") == company).select("web_site_sk")
    rets = t.web_returns.select(c("wr_order_number").alias("r_order"))
    return _multi_wh_totals(t, t.web_sales, "ws", ws, "ws_web_site_sk", state, start, rets, "in")


@register("q45")
def q45(spark, sf_dir, zips=("10311", "10622", "13421", "16530", "19639", "85669"),
        item_sks=(2, 3, 5, 7, 11, 13, 17, 19, 23, 29), qoy=2, year=2000):
    """``zip IN (..) OR i_item_id IN (subquery)``: an existence flag from a
    join on the distinct ids, then one filter."""
    t = Tables(spark, sf_dir)
    ids = t.item.filter(c("i_item_sk").isin(list(item_sks))).select("i_item_id")
    it = with_flag(t.item.select("i_item_sk", "i_item_id"), ids, ["i_item_id"], ["i_item_id"], "listed")
    j = (t.web_sales.select("ws_bill_customer_sk", "ws_item_sk", "ws_sold_date_sk", "ws_sales_price")
         .transform(t.on_days, "ws_sold_date_sk", t.date_dim.filter((c("d_qoy") == qoy) & (c("d_year") == year)).select("d_date_sk"))
         .join(t.customer.select("c_customer_sk", "c_current_addr_sk"), c("ws_bill_customer_sk") == c("c_customer_sk"))
         .join(t.customer_address.select("ca_address_sk", "ca_zip", "ca_county"),
               c("c_current_addr_sk") == c("ca_address_sk"))
         .join(it, c("ws_item_sk") == c("i_item_sk")))
    j = j.filter(F.substring("ca_zip", 1, 5).isin(list(zips)) | c("listed"))
    g = j.groupBy("ca_zip", "ca_county").agg(F.sum("ws_sales_price").cast("decimal(38,2)").alias("sum_sales_price"))
    return topk(g, ["ca_zip", "ca_county"])


def _week_dates(t, days):
    """Dates of the weeks that contain any of ``days`` (nested IN lookups)."""
    wk = t.date_dim.filter(c("d_date").isin([F.lit(d).cast("date") for d in days])).select(
        c("d_week_seq").alias("wk")).distinct()
    return t.date_dim.join(wk, c("d_week_seq") == c("wk"), "left_semi").select("d_date_sk")


def _item_totals(t, fact, item_col, date_col, value, dates, name):
    return (fact.select(item_col, date_col, value).transform(t.on_days, date_col, dates)
            .join(t.item.select("i_item_sk", "i_item_id"), c(item_col) == c("i_item_sk"))
            .groupBy(c("i_item_id").alias(f"{name}_id")).agg(F.sum(value).alias(name)))


@register("q58")
def q58(spark, sf_dir, day="1998-05-03", lo=0.25, hi=4.0):
    """Items whose weekly revenue is within [lo, hi] of each other in all
    three channels (the suite uses 0.9 / 1.1 on its own data)."""
    t = Tables(spark, sf_dir)
    dates = _week_dates(t, [day])
    ss = _item_totals(t, t.store_sales, "ss_item_sk", "ss_sold_date_sk", "ss_ext_sales_price", dates, "ss")
    cs = _item_totals(t, t.catalog_sales, "cs_item_sk", "cs_sold_date_sk", "cs_ext_sales_price", dates, "cs")
    ws = _item_totals(t, t.web_sales, "ws_item_sk", "ws_sold_date_sk", "ws_ext_sales_price", dates, "ws")
    j = ss.join(cs, c("ss_id") == c("cs_id")).join(ws, c("ss_id") == c("ws_id"))
    L, H = F.lit(str(lo)).cast("decimal(6,2)"), F.lit(str(hi)).cast("decimal(6,2)")

    def within(a, b):
        return c(a).between(L * c(b), H * c(b))
    j = j.filter(within("ss", "cs") & within("ss", "ws") & within("cs", "ss") & within("cs", "ws")
                 & within("ws", "ss") & within("ws", "cs"))
    tot = c("ss") + c("cs") + c("ws")
    out = j.select(c("ss_id").alias("item_id"), c("ss").cast("decimal(38,2)").alias("ss_item_rev"),
                   quotient4(c("ss") * 100, tot * 3).alias("ss_dev"), c("cs").cast("decimal(38,2)").alias("cs_item_rev"),
                   quotient4(c("cs") * 100, tot * 3).alias("cs_dev"), c("ws").cast("decimal(38,2)").alias("ws_item_rev"),
                   quotient4(c("ws") * 100, tot * 3).alias("ws_dev"), quotient4(tot, F.lit(3)).alias("average"))
    return topk(out, ["item_id", "ss_item_rev"])


@register("q83")
def q83(spark, sf_dir, days=("1996-02-04", "2000-06-18", "2000-12-24")):
    t = Tables(spark, sf_dir)
    dates = _week_dates(t, list(days))
    sr = _item_totals(t, t.store_returns, "sr_item_sk", "sr_returned_date_sk", "sr_return_quantity", dates, "sr")
    cr = _item_totals(t, t.catalog_returns, "cr_item_sk", "cr_returned_date_sk", "cr_return_quantity", dates, "cr")
    wr = _item_totals(t, t.web_returns, "wr_item_sk", "wr_returned_date_sk", "wr_return_quantity", dates, "wr")
    j = sr.join(cr, c("sr_id") == c("cr_id")).join(wr, c("sr_id") == c("wr_id"))
    tot = c("sr") + c("cr") + c("wr")
    out = j.select(c("sr_id").alias("item_id"), c("sr").cast("bigint").alias("sr_item_qty"),
                   quotient4(c("sr") * 100, tot * 3).alias("sr_dev"), c("cr").cast("bigint").alias("cr_item_qty"),
                   quotient4(c("cr") * 100, tot * 3).alias("cr_dev"), c("wr").cast("bigint").alias("wr_item_qty"),
                   quotient4(c("wr") * 100, tot * 3).alias("wr_dev"), quotient4(tot, F.lit(3)).alias("average"))
    return topk(out, ["item_id", "sr_item_qty"])
