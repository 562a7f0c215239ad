"""Shopping-basket group: per-ticket aggregates filtered by household and
store attributes, then joined to the customer (q34 q46 q68 q73 q79)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...operators.sorts import topk
from ..registry import register
from .common import Tables

c = F.col


def _away_from_home(t, dows, years, cities, dep, vehicles, values):
    """Tickets bought in a city other than the buyer's current one."""
    d = t.date_dim.filter(c("d_dow").isin(list(dows)) & c("d_year").isin(list(years))).select("d_date_sk")
    st = t.store.filter(c("s_city").isin(list(cities))).select("s_store_sk")
    hd = t.household_demographics.filter((c("hd_dep_count") == dep) | (c("hd_vehicle_count") == vehicles)) \
        .select("hd_demo_sk")
    ca = t.customer_address.select(c("ca_address_sk").alias("b_addr"), c("ca_city").alias("bought_city"))
    j = (t.store_sales.transform(t.on_days, "ss_sold_date_sk", d).join(st, c("ss_store_sk") == c("s_store_sk"))
         .join(hd, c("ss_hdemo_sk") == c("hd_demo_sk")).join(ca, c("ss_addr_sk") == c("b_addr")))
    dn = j.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city").agg(
        *[F.sum(v).cast("decimal(38,2)").alias(n) for v, n in values])
    cur = t.customer_address.select(c("ca_address_sk").alias("cur_addr"), "ca_city")
    return (dn.join(t.customer.select("c_customer_sk", "c_current_addr_sk", "c_last_name", "c_first_name"),
                    c("ss_customer_sk") == c("c_customer_sk"))
            .join(cur, (c("c_current_addr_sk") == c("cur_addr")) & (c("ca_city") != c("bought_city"))))


@register("q46")
def q46(spark, sf_dir, dows=(6, 0), years=(1999, 2000, 2001), cities=("Midway", "Fairview", "Fairview", "Fairview", "Fairview"),
        dep=5, vehicles=3):
    t = Tables(spark, sf_dir)
    j = _away_from_home(t, dows, years, cities, dep, vehicles, [("ss_coupon_amt", "amt"), ("ss_net_profit", "profit")])
    out = j.select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "amt", "profit")
    return topk(out, ["c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number"])


@register("q68")
def q68(spark, sf_dir, dom_hi=2, years=(1999, 2000, 2001), cities=("Midway", "Fairview"), dep=5, vehicles=3):
    t = Tables(spark, sf_dir)
    # same shape as q46 with day-of-month days and three sums
    d = t.date_dim.filter(c("d_dom").between(1, dom_hi) & c("d_year").isin(list(years))).select("d_date_sk")
    st = t.store.filter(c("s_city").isin(list(cities))).select("s_store_sk")
    hd = t.household_demographics.filter((c("hd_dep_count") == dep) | (c("hd_vehicle_count") == vehicles)) \
        .select("hd_demo_sk")
    ca = t.customer_address.select(c("ca_address_sk").alias("b_addr"), c("ca_city").alias("bought_city"))
    j = (t.store_sales.transform(t.on_days, "ss_sold_date_sk", d).join(st, c("ss_store_sk") == c("s_store_sk"))
         .join(hd, c("ss_hdemo_sk") == c("hd_demo_sk")).join(ca, c("ss_addr_sk") == c("b_addr")))
    dn = j.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city").agg(
        F.sum("ss_ext_sales_price").cast("decimal(38,2)").alias("extended_price"),
        F.sum("ss_ext_list_price").cast("decimal(38,2)").alias("list_price"),
        F.sum("ss_ext_tax").cast("decimal(38,2)").alias("extended_tax"))
    cur = t.customer_address.select(c("ca_address_sk").alias("cur_addr"), "ca_city")
    out = (dn.join(t.customer.select("c_customer_sk", "c_current_addr_sk", "c_last_name", "c_first_name"),
                   c("ss_customer_sk") == c("c_customer_sk"))
           .join(cur, (c("c_current_addr_sk") == c("cur_addr")) & (c("ca_city") != c("bought_city")))
           .select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "extended_price",
                   "extended_tax", "list_price"))
    return topk(out, ["c_last_name", "ss_ticket_number"])


def _ticket_counts(t, dom_cond, potentials, ratio, years, counties, lo, hi):
    """Tickets with lo..hi lines for households with many dependants per
    vehicle.  ``dep / vehicles`` is integer division in the suite's dialect."""
    from ...functions.scalars import int_div
    d = t.date_dim.filter(dom_cond & c("d_year").isin(list(years))).select("d_date_sk")
    st = t.store.filter(c("s_county").isin(list(counties))).select("s_store_sk")
    hd = t.household_demographics.filter(
        c("hd_buy_potential").isin(list(potentials)) & (c("hd_vehicle_count") > 0)
        & (F.when(c("hd_vehicle_count") > 0, int_div(c("hd_dep_count"), c("hd_vehicle_count"))) > ratio)) \
        .select("hd_demo_sk")
    dn = (t.store_sales.transform(t.on_days, "ss_sold_date_sk", d).join(st, c("ss_store_sk") == c("s_store_sk"))
          .join(hd, c("ss_hdemo_sk") == c("hd_demo_sk"))
          .groupBy("ss_ticket_number", "ss_customer_sk").agg(F.count(F.lit(1)).alias("cnt")))
    return (dn.filter(c("cnt").between(lo, hi))
            .join(t.customer.select("c_customer_sk", "c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag"),
                  c("ss_customer_sk") == c("c_customer_sk"))
            .select("c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt"))


COUNTIES8 = ("Walker County", "Walker County", "Ziebach County", "Fairfield County", "Richland County",
             "Franklin Parish", "Bronx County", "Barrow County")


@register("q34")
def q34(spark, sf_dir, potentials=(">10000", "unknown"), ratio=1.2, years=(1998, 1999, 2000), counties=COUNTIES8,
        lo=4, hi=20):
    """'unknown' is spelled in lower case in the text, so it matches nothing
    (kept).  No LIMIT: the whole ordered result is returned."""
    from ...operators.sorts import order
    t = Tables(spark, sf_dir)
    dom = c("d_dom").between(1, 3) | c("d_dom").between(25, 28)
    x = _ticket_counts(t, dom, potentials, ratio, years, counties, lo, hi)
    return order(x, ["c_last_name", "c_first_name", "c_salutation", "-c_preferred_cust_flag"])


@register("q73")
def q73(spark, sf_dir, potentials=(">10000", "unknown"), ratio=1, years=(1998, 1999, 2000),
        counties=COUNTIES8[:4], lo=1, hi=5):
    from ...operators.sorts import order
    t = Tables(spark, sf_dir)
    x = _ticket_counts(t, c("d_dom").between(1, 2), potentials, ratio, years, counties, lo, hi)
    return order(x, ["-cnt"])


@register("q79")
def q79(spark, sf_dir, dep=8, dow=1, years=(1998, 1999, 2000), emp_lo=200, emp_hi=295):
    t = Tables(spark, sf_dir)
    d = t.date_dim.filter((c("d_dow") == dow) & c("d_year").isin(list(years))).select("d_date_sk")
    st = t.store.filter(c("s_number_employees").between(emp_lo, emp_hi)).select("s_store_sk", "s_city")
    hd = t.household_demographics.filter((c("hd_dep_count") == dep) | (c("hd_vehicle_count") > 0)).select("hd_demo_sk")
    ms = (t.store_sales.transform(t.on_days, "ss_sold_date_sk", d).join(st, c("ss_store_sk") == c("s_store_sk"))
          .join(hd, c("ss_hdemo_sk") == c("hd_demo_sk"))
          .groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city")
          .agg(F.sum("ss_coupon_amt").cast("decimal(38,2)").alias("amt"),
               F.sum("ss_net_profit").cast("decimal(38,2)").alias("profit")))
    out = (ms.join(t.customer.select("c_customer_sk", "c_last_name", "c_first_name"), c("ss_customer_sk") == c("c_customer_sk"))
           .select("c_last_name", "c_first_name", F.substring("s_city", 1, 30).alias("city30"), "ss_ticket_number",
                   "amt", "profit"))
    return topk(out, ["c_last_name", "c_first_name", "city30", "profit"])
