"""Correlated-subquery group, decorrelated into joins.

``x > f * (SELECT avg(x) FROM t2 WHERE t2.k = t1.k)`` becomes one aggregate
by ``k`` joined back on ``k`` (an equi-join, planned like any other);
EXISTS / NOT EXISTS become semi / anti joins on distinct keys.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import money_sum
from ...operators.sorts import topk
from ...operators.subqueries import above_group_avg
from ..registry import register
from .common import Tables

c = F.col
SALTS = 64  # parts of a store or a state, of which there are few


def _ctr(t, fact, cust, group2, value, date_col, dt):
    return (fact.transform(t.on_days, date_col, dt)
            .groupBy(c(cust).alias("ctr_customer_sk"), group2)
            .agg(F.sum(value).alias("ctr_total_return")))


@register("q01")
def q01(spark, sf_dir, year=2000, state="TN", factor=1.2):
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter(c("d_year") == year).select("d_date_sk")
    ctr = _ctr(t, t.store_returns, "sr_customer_sk", c("sr_store_sk").alias("ctr_store_sk"), "sr_fee",
               "sr_returned_date_sk", dt)
    hi = above_group_avg(ctr, "ctr_store_sk", "ctr_total_return", factor, salts=SALTS)
    j = (hi.join(t.store.filter(c("s_state") == state).select("s_store_sk"), c("s_store_sk") == c("ctr_store_sk"))
         .join(t.customer.select("c_customer_sk", "c_customer_id"), c("ctr_customer_sk") == c("c_customer_sk")))
    return topk(j.select("c_customer_id"), ["c_customer_id"])


@register("q06")
def q06(spark, sf_dir, year=2000, moy=2, factor=1.2, min_count=10):
    t = Tables(spark, sf_dir)
    ms = t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select(c("d_month_seq").alias("ms")).distinct()
    dt = t.date_dim.join(ms, c("d_month_seq") == c("ms"), "left_semi").select("d_date_sk")
    it = above_group_avg(t.item.select("i_item_sk", "i_category", "i_current_price"), "i_category",
                         "i_current_price", factor)
    j = (t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_customer_sk")
         .transform(t.on_days, "ss_sold_date_sk", dt)
         .join(it, c("ss_item_sk") == c("i_item_sk"))
         .join(t.customer.select("c_customer_sk", "c_current_addr_sk"), c("c_customer_sk") == c("ss_customer_sk"))
         .join(t.customer_address.select("ca_address_sk", "ca_state"), c("ca_address_sk") == c("c_current_addr_sk")))
    g = (j.groupBy(c("ca_state").alias("state")).agg(F.count(F.lit(1)).alias("cnt"))
         .filter(c("cnt") >= min_count))
    return topk(g, ["cnt"])


CUST_COLS = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "c_preferred_cust_flag",
             "c_birth_day", "c_birth_month", "c_birth_year", "c_birth_country", "c_login", "c_email_address",
             "c_last_review_date"]
ADDR_COLS = ["ca_street_number", "ca_street_name", "ca_street_type", "ca_suite_number", "ca_city", "ca_county",
             "ca_state", "ca_zip", "ca_country", "ca_gmt_offset", "ca_location_type"]


def _state_returners(t, fact, p, value, year, state, factor):
    dt = t.date_dim.filter(c("d_year") == year).select("d_date_sk")
    ret = (fact.transform(t.on_days, f"{p}_returned_date_sk", dt)
           .join(t.customer_address.select(c("ca_address_sk").alias("r_addr"), c("ca_state").alias("ctr_state")),
                 c(f"{p}_returning_addr_sk") == c("r_addr")))
    ctr = (ret.groupBy(c(f"{p}_returning_customer_sk").alias("ctr_customer_sk"), "ctr_state")
           .agg(F.sum(value).alias("ctr_total_return")))
    hi = above_group_avg(ctr, "ctr_state", "ctr_total_return", factor, salts=SALTS)
    ca = t.customer_address.filter(c("ca_state") == state)
    return (hi.join(t.customer, c("ctr_customer_sk") == c("c_customer_sk"))
            .join(ca, c("ca_address_sk") == c("c_current_addr_sk")))


@register("q30")
def q30(spark, sf_dir, year=2000, state="IL", factor=1.2):
    t = Tables(spark, sf_dir)
    j = _state_returners(t, t.web_returns, "wr", "wr_return_amt", year, state, factor)
    out = j.select(*CUST_COLS, c("ctr_total_return").cast("decimal(38,2)").alias("ctr_total_return"))
    return topk(out, CUST_COLS + ["ctr_total_return"])


@register("q81")
def q81(spark, sf_dir, year=1998, state="IL", factor=1.2):
    t = Tables(spark, sf_dir)
    j = _state_returners(t, t.catalog_returns, "cr", "cr_return_amt_inc_tax", year, state, factor)
    cols = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", *[a for a in ADDR_COLS]]
    out = j.select(*cols, c("ctr_total_return").cast("decimal(38,2)").alias("ctr_total_return"))
    return topk(out, cols + ["ctr_total_return"])


def _excess_discount(t, fact, p, manufact_id, start, factor, name):
    d0 = F.lit(start).cast("date")
    dt = t.date_dim.filter(c("d_date").between(d0, F.date_add(d0, 90))).select("d_date_sk")
    it = t.item.filter(c("i_manufact_id") == manufact_id).select("i_item_sk")
    s = (fact.select(f"{p}_item_sk", f"{p}_sold_date_sk", f"{p}_ext_discount_amt")
         .transform(t.on_days, f"{p}_sold_date_sk", dt)
         .join(it, c("i_item_sk") == c(f"{p}_item_sk")))
    hi = above_group_avg(s, f"{p}_item_sk", f"{p}_ext_discount_amt", factor)
    return hi.agg(money_sum(f"{p}_ext_discount_amt").alias(name))


@register("q32")
def q32(spark, sf_dir, manufact_id=35, start="1998-03-18", factor=1.3):
    t = Tables(spark, sf_dir)
    return _excess_discount(t, t.catalog_sales, "cs", manufact_id, start, factor, "excess discount amount").limit(100)


@register("q92")
def q92(spark, sf_dir, manufact_id=29, start="1998-03-18", factor=1.3):
    t = Tables(spark, sf_dir)
    return _excess_discount(t, t.web_sales, "ws", manufact_id, start, factor, "Excess Discount Amount").limit(100)


# Attribute branches of q41: (category, colours, units, sizes); values of this
# repo's item dimension.
Q41_BRANCHES = [
    ("Women", ("purple", "pale"), ("Bunch", "Lb"), ("large", "petite")),
    ("Women", ("floral", "chiffon"), ("Gross", "Box"), ("N/A", "extra large")),
    ("Men", ("burnished", "slate"), ("Dozen", "Case"), ("large", "small")),
    ("Men", ("medium", "indian"), ("Oz", "Each"), ("small", "medium")),
    ("Women", ("aquamarine", "burlywood"), ("Lb", "Oz"), ("petite", "medium")),
    ("Women", ("spring", "slate"), ("Case", "Dozen"), ("N/A", "extra large")),
    ("Men", ("blanched", "pale"), ("Bunch", "Each"), ("small", "large")),
    ("Men", ("burlywood", "aquamarine"), ("Gross", "Bunch"), ("petite", "medium")),
]


def q41_branch_sql() -> str:
    arms = []
    for cat, colors, units, sizes in Q41_BRANCHES:
        arms.append(f"(i_category = '{cat}' AND (i_color = '{colors[0]}' OR i_color = '{colors[1]}') "
                    f"AND (i_units = '{units[0]}' OR i_units = '{units[1]}') "
                    f"AND (i_size = '{sizes[0]}' OR i_size = '{sizes[1]}'))")
    return "\n   OR ".join(arms)


@register("q41")
def q41(spark, sf_dir, manufact_lo=1, span=40):
    """``(SELECT count(*) FROM item WHERE i_manufact = i1.i_manufact AND ...) > 0``:
    the manufacturers having a matching item are found once (distinct) and
    semi-joined to the outer item rows."""
    t = Tables(spark, sf_dir)
    cond = None
    for cat, colors, units, sizes in Q41_BRANCHES:
        x = ((c("i_category") == cat) & c("i_color").isin(*colors) & c("i_units").isin(*units)
             & c("i_size").isin(*sizes))
        cond = x if cond is None else cond | x
    good = t.item.filter(cond).select(c("i_manufact").alias("good_manufact")).distinct()
    outer = t.item.filter(c("i_manufact_id").between(manufact_lo, manufact_lo + span))
    out = outer.join(good, c("i_manufact") == c("good_manufact"), "left_semi").select("i_product_name").distinct()
    return topk(out, ["i_product_name"])


def _active(t, fact, cust_col, date_col, dcond):
    dt = t.date_dim.filter(dcond).select("d_date_sk")
    return fact.select(cust_col, date_col).transform(t.on_days, date_col, dt).select(c(cust_col).alias("_cust"))


def _demo_customers(t, addr_cond):
    return (t.customer.select("c_customer_sk", "c_current_addr_sk", "c_current_cdemo_sk")
            .join(t.customer_address.filter(addr_cond).select("ca_address_sk", "ca_state"),
                  c("c_current_addr_sk") == c("ca_address_sk"))
            .join(t.customer_demographics, c("cd_demo_sk") == c("c_current_cdemo_sk")))


@register("q10")
def q10(spark, sf_dir, counties=("Walker County", "Richland County", "Ziebach County", "Fairfield County",
                                 "Bronx County"), year=2000, moy=4):
    from ...operators.joins import exists_flags
    t = Tables(spark, sf_dir)
    dc = (c("d_year") == year) & c("d_moy").between(moy, moy + 3)
    cust = _demo_customers(t, c("ca_county").isin(list(counties)))
    ok = exists_flags(cust, ["c_customer_sk"], _active(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", dc),
                      ["_cust"],
                      [(_active(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", dc), ["_cust"]),
                       (_active(t, t.catalog_sales, "cs_ship_customer_sk", "cs_sold_date_sk", dc), ["_cust"])])
    keys = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating",
            "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]
    g = ok.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = g.select("cd_gender", "cd_marital_status", "cd_education_status", c("n").alias("cnt1"),
                   "cd_purchase_estimate", c("n").alias("cnt2"), "cd_credit_rating", c("n").alias("cnt3"),
                   "cd_dep_count", c("n").alias("cnt4"), "cd_dep_employed_count", c("n").alias("cnt5"),
                   "cd_dep_college_count", c("n").alias("cnt6"))
    return topk(out, keys)


@register("q35")
def q35(spark, sf_dir, year=1999, max_qoy=4):
    from ...functions.scalars import avg4
    from ...operators.joins import exists_flags
    t = Tables(spark, sf_dir)
    dc = (c("d_year") == year) & (c("d_qoy") < max_qoy)
    cust = _demo_customers(t, F.lit(True))
    ok = exists_flags(cust, ["c_customer_sk"], _active(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", dc),
                      ["_cust"],
                      [(_active(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", dc), ["_cust"]),
                       (_active(t, t.catalog_sales, "cs_ship_customer_sk", "cs_sold_date_sk", dc), ["_cust"])])
    keys = ["ca_state", "cd_gender", "cd_marital_status", "cd_dep_count", "cd_dep_employed_count",
            "cd_dep_college_count"]
    aggs = [F.count(F.lit(1)).alias("n")]
    for short, col in (("dep", "cd_dep_count"), ("emp", "cd_dep_employed_count"), ("col", "cd_dep_college_count")):
        aggs += [avg4(col).alias(f"avg_{short}"), F.max(col).alias(f"max_{short}"),
                 F.sum(col).cast("bigint").alias(f"sum_{short}")]
    g = ok.groupBy(*keys).agg(*aggs)
    out = g.select("ca_state", "cd_gender", "cd_marital_status", c("n").alias("cnt1"),
                   "avg_dep", "max_dep", "sum_dep", "cd_dep_employed_count", c("n").alias("cnt2"),
                   "avg_emp", "max_emp", "sum_emp", "cd_dep_college_count", c("n").alias("cnt3"),
                   "avg_col", "max_col", "sum_col", "cd_dep_count")
    return topk(out, keys).drop("cd_dep_count")


@register("q69")
def q69(spark, sf_dir, states=("IL", "KY", "GA"), year=1999, moy=1):
    """EXISTS store AND NOT EXISTS web AND NOT EXISTS catalog: one semi join
    and two anti joins on distinct customer keys."""
    from ...operators.joins import not_exists, semi
    t = Tables(spark, sf_dir)
    dc = (c("d_year") == year) & c("d_moy").between(moy, moy + 2)
    cust = _demo_customers(t, c("ca_state").isin(list(states)))
    ok = semi(cust, _active(t, t.store_sales, "ss_customer_sk", "ss_sold_date_sk", dc), ["c_customer_sk"], ["_cust"])
    ok = not_exists(ok, _active(t, t.web_sales, "ws_bill_customer_sk", "ws_sold_date_sk", dc), ["c_customer_sk"], ["_cust"])
    ok = not_exists(ok, _active(t, t.catalog_sales, "cs_ship_customer_sk", "cs_sold_date_sk", dc),
                    ["c_customer_sk"], ["_cust"])
    keys = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating"]
    g = ok.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    out = g.select("cd_gender", "cd_marital_status", "cd_education_status", c("n").alias("cnt1"),
                   "cd_purchase_estimate", c("n").alias("cnt2"), "cd_credit_rating", c("n").alias("cnt3"))
    return topk(out, keys)
