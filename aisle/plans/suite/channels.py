"""Cross-channel group: the same measure per channel and period compared
side by side.

The suite writes these as self-joins of one aggregate, four to six times,
filtered to one (channel, year) each.  Here they are one aggregation with
conditional sums per (channel, period): a single shuffle keyed by the
customer (or county), no join fan-out.  Inner-join semantics are kept: a
missing (channel, period) row gives a NULL conditional sum, and every
predicate over a NULL is false, exactly like the row that the inner join
would not have produced.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import mean, quotient4, safe_div
from ...operators.aggs import pivot_sums
from ...operators.sorts import topk, order
from ..registry import register
from .common import Tables

c = F.col

_DAYS = {"sun": "Sunday", "mon": "Monday", "tue": "Tuesday", "wed": "Wednesday", "thu": "Thursday",
         "fri": "Friday", "sat": "Saturday"}


@register("q02")
def q02(spark, sf_dir, year=1998):
    """Web + catalog weekly sales by weekday, this year's week against the
    week 53 weeks later.  Each week row is joined to its days in the year
    (up to seven copies, as the text does) before the offset self-join."""
    t = Tables(spark, sf_dir)
    # Only weeks that touch the two years are ever joined; restricting the
    # dates to those whole weeks before aggregating gives the same weekly
    # sums without aggregating the rest of the history.
    weeks = t.date_dim.filter(c("d_year").isin(year, year + 1)).select(c("d_week_seq").alias("w")).distinct()
    days = t.date_dim.join(weeks, c("d_week_seq") == c("w"), "left_semi").select("d_date_sk", "d_week_seq", "d_day_name")
    wscs = (t.in_days(t.web_sales, "ws_sold_date_sk", days)
            .select(c("ws_sold_date_sk").alias("sold_date_sk"), c("ws_ext_sales_price").alias("sales_price"))
            .unionByName(t.in_days(t.catalog_sales, "cs_sold_date_sk", days)
                         .select(c("cs_sold_date_sk").alias("sold_date_sk"), c("cs_ext_sales_price").alias("sales_price"))))
    wk = (wscs.join(days, c("d_date_sk") == c("sold_date_sk"))
          .groupBy("d_week_seq").agg(*[x.alias(a) for x, a in zip(pivot_sums("d_day_name", _DAYS, "sales_price"), _DAYS)]))

    def side(y, n):
        d = t.date_dim.filter(c("d_year") == y).select(c("d_week_seq").alias("dw"))
        return wk.join(d, c("d_week_seq") == c("dw")).select(c("d_week_seq").alias(f"wk{n}"),
                                                              *[c(a).alias(f"{a}{n}") for a in _DAYS])
    j = side(year, 1).join(side(year + 1, 2), c("wk1") == c("wk2") - 53)
    out = j.select(c("wk1").alias("d_week_seq1"),
                   *[F.round(c(f"{a}1") / c(f"{a}2"), 2).cast("double").alias(f"{a}_ratio") for a in _DAYS])
    return order(out, ["d_week_seq1"])


@register("q59")
def q59(spark, sf_dir, month_seq=1188):
    t = Tables(spark, sf_dir)
    # as in q02: aggregate only the whole weeks that the two month ranges touch
    weeks = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 23)).select(c("d_week_seq").alias("w")).distinct()
    days = t.date_dim.join(weeks, c("d_week_seq") == c("w"), "left_semi").select("d_date_sk", "d_week_seq", "d_day_name")
    wss = (t.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_sales_price")
           .transform(t.on_days, "ss_sold_date_sk", days)
           .groupBy("d_week_seq", "ss_store_sk")
           .agg(*[x.alias(a) for x, a in zip(pivot_sums("d_day_name", _DAYS, "ss_sales_price"), _DAYS)]))
    st = t.store.select("s_store_sk", "s_store_name", "s_store_id")

    def side(lo, n):
        d = t.date_dim.filter(c("d_month_seq").between(lo, lo + 11)).select(c("d_week_seq").alias("dw"))
        return (wss.join(st, c("ss_store_sk") == c("s_store_sk")).join(d, c("dw") == c("d_week_seq"))
                .select(c("s_store_name").alias(f"s_store_name{n}"), c("s_store_id").alias(f"s_store_id{n}"),
                        c("d_week_seq").alias(f"d_week_seq{n}"), *[c(a).alias(f"{a}{n}") for a in _DAYS]))
    j = side(month_seq, 1).join(side(month_seq + 12, 2),
                                (c("s_store_id1") == c("s_store_id2")) & (c("d_week_seq1") == c("d_week_seq2") - 52))
    out = j.select("s_store_name1", "s_store_id1", "d_week_seq1",
                   *[quotient4(f"{a}1", f"{a}2").alias(f"{a}_ratio") for a in _DAYS])
    return topk(out, ["s_store_name1", "s_store_id1", "d_week_seq1"])


CUST_ATTRS = ["c_customer_id", "c_first_name", "c_last_name", "c_preferred_cust_flag", "c_birth_country",
              "c_login", "c_email_address"]


def _channel_years(t, channels, years, measure_fn, agg=F.sum, attrs=CUST_ATTRS):
    """One row per customer with ``<type><i>`` = aggregate of the channel's
    measure in ``years[i]`` (NULL when the customer had no such sale).

    The facts are first aggregated per customer key (partial aggregation
    before the shuffle, which is keyed by the customer key); only that
    per-customer result meets the customer dimension, and a second, small
    aggregation regroups it by the customer attributes the text groups by.
    Sums and maxima both compose."""
    d = t.date_dim.filter(c("d_year").isin(list(years))).select("d_date_sk", "d_year")
    parts = []
    for typ, fact, p, cust in channels:
        fact = t.in_days(fact, f"{p}_sold_date_sk", d)
        parts.append(fact.select(c(cust).alias("cust_sk"), c(f"{p}_sold_date_sk").alias("date_sk"),
                                 F.lit(typ).alias("sale_type"), measure_fn(p).alias("v")))
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x)
    names = [f"{typ}{i + 1}" for typ, *_ in channels for i in range(len(years))]
    cols = []
    for typ, *_ in channels:
        for i, y in enumerate(years):
            cols.append(agg(F.when((c("sale_type") == typ) & (c("d_year") == y), c("v"))).alias(f"{typ}{i + 1}"))
    per_sk = u.join(d, c("date_sk") == c("d_date_sk")).groupBy("cust_sk").agg(*cols)
    j = per_sk.join(t.customer.select("c_customer_sk", *attrs), c("cust_sk") == c("c_customer_sk"))
    return j.groupBy(*attrs).agg(*[agg(n).alias(n) for n in names])


def _growth_beats(a, b):
    """``a2/a1 > b2/b1`` with the CASE guards of the text (NULL -> false)."""
    return safe_div(f"{a}2", f"{a}1") > safe_div(f"{b}2", f"{b}1")


@register("q04")
def q04(spark, sf_dir, year=1998):
    t = Tables(spark, sf_dir)
    chans = [("s", t.store_sales, "ss", "ss_customer_sk"), ("c", t.catalog_sales, "cs", "cs_bill_customer_sk"),
             ("w", t.web_sales, "ws", "ws_bill_customer_sk")]

    def m(p):
        return ((c(f"{p}_ext_list_price") - c(f"{p}_ext_wholesale_cost") - c(f"{p}_ext_discount_amt"))
                + c(f"{p}_ext_sales_price")) / 2
    y = _channel_years(t, chans, [year, year + 1], m)
    y = y.filter((c("s1") > 0) & (c("c1") > 0) & (c("w1") > 0) & c("s2").isNotNull() & c("c2").isNotNull()
                 & c("w2").isNotNull() & _growth_beats("c", "s") & _growth_beats("c", "w"))
    return topk(y.select(c("c_preferred_cust_flag").alias("customer_preferred_cust_flag")),
                ["customer_preferred_cust_flag"])


@register("q11")
def q11(spark, sf_dir, year=1998):
    t = Tables(spark, sf_dir)
    chans = [("s", t.store_sales, "ss", "ss_customer_sk"), ("w", t.web_sales, "ws", "ws_bill_customer_sk")]
    y = _channel_years(t, chans, [year, year + 1],
                       lambda p: c(f"{p}_ext_list_price") - c(f"{p}_ext_discount_amt"))
    y = y.filter((c("s1") > 0) & (c("w1") > 0) & c("s2").isNotNull() & c("w2").isNotNull() & _growth_beats("w", "s"))
    return topk(y.select(c("c_preferred_cust_flag").alias("customer_preferred_cust_flag")),
                ["customer_preferred_cust_flag"])


@register("q74")
def q74(spark, sf_dir, year=1998):
    t = Tables(spark, sf_dir)
    chans = [("s", t.store_sales, "ss", "ss_customer_sk"), ("w", t.web_sales, "ws", "ws_bill_customer_sk")]
    y = _channel_years(t, chans, [year, year + 1], lambda p: c(f"{p}_net_paid"), agg=F.max,
                       attrs=["c_customer_id", "c_first_name", "c_last_name"])
    y = y.filter((c("s1") > 0) & (c("w1") > 0) & c("s2").isNotNull() & c("w2").isNotNull() & _growth_beats("w", "s"))
    out = y.select(c("c_customer_id").alias("customer_id"), c("c_first_name").alias("customer_first_name"),
                   c("c_last_name").alias("customer_last_name"))
    return topk(out, ["customer_first_name", "customer_id", "customer_last_name"])


@register("q31")
def q31(spark, sf_dir, year=1997):
    """Counties whose web growth beats store growth, quarter 1->2 and 2->3."""
    t = Tables(spark, sf_dir)
    d = t.date_dim.filter(c("d_year") == year).select("d_date_sk", "d_qoy", "d_year")
    ca = t.customer_address.select("ca_address_sk", "ca_county")
    ss = t.in_days(t.store_sales, "ss_sold_date_sk", d).select(
        c("ss_sold_date_sk").alias("dsk"), c("ss_addr_sk").alias("ask"), c("ss_ext_sales_price").alias("v"), F.lit("s").alias("ch"))
    ws = t.in_days(t.web_sales, "ws_sold_date_sk", d).select(
        c("ws_sold_date_sk").alias("dsk"), c("ws_bill_addr_sk").alias("ask"), c("ws_ext_sales_price").alias("v"), F.lit("w").alias("ch"))
    # aggregate per address key first, then bring in the county (one row per address)
    cols = [F.sum(F.when((c("ch") == ch) & (c("d_qoy") == q), c("v"))).alias(f"{ch}{q}")
            for ch in ("s", "w") for q in (1, 2, 3)]
    per_addr = ss.unionByName(ws).join(d, c("dsk") == c("d_date_sk")).groupBy("ask", "d_year").agg(*cols)
    g = (per_addr.join(ca, c("ask") == c("ca_address_sk"))
         .groupBy("ca_county", "d_year").agg(*[F.sum(f"{ch}{q}").alias(f"{ch}{q}") for ch in ("s", "w") for q in (1, 2, 3)]))
    g = g.filter(c("s1").isNotNull() & c("s2").isNotNull() & c("s3").isNotNull() & c("w1").isNotNull()
                 & c("w2").isNotNull() & c("w3").isNotNull()
                 & (safe_div("w2", "w1") > safe_div("s2", "s1")) & (safe_div("w3", "w2") > safe_div("s3", "s2")))
    out = g.select("ca_county", "d_year", quotient4("w2", "w1").alias("web_q1_q2_increase"),
                   quotient4("s2", "s1").alias("store_q1_q2_increase"),
                   quotient4("w3", "w2").alias("web_q2_q3_increase"),
                   quotient4("s3", "s2").alias("store_q2_q3_increase"))
    return order(out, ["d_year"])


def _three_channel_sales(t, key, item_filter, year, moy, gmt):
    """Q33 / Q56 / Q60: per-channel sales of the listed items by ``key``,
    union all, re-aggregated.  The IN subquery is a semi join on the
    distinct listed keys; each channel is pre-aggregated before the union."""
    from ...operators.joins import semi
    listed = t.item.filter(item_filter).select(c(key).alias("_k"))
    it = semi(t.item.select("i_item_sk", key), listed, [key], ["_k"])
    d = t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    ca = t.customer_address.filter(c("ca_gmt_offset") == gmt).select("ca_address_sk")
    parts = []
    for fact, p, addr in ((t.store_sales, "ss", "ss_addr_sk"), (t.catalog_sales, "cs", "cs_bill_addr_sk"),
                          (t.web_sales, "ws", "ws_bill_addr_sk")):
        parts.append(fact.select(f"{p}_item_sk", f"{p}_sold_date_sk", addr, f"{p}_ext_sales_price")
                     .transform(t.on_days, f"{p}_sold_date_sk", d)
                     .join(ca, c(addr) == c("ca_address_sk"))
                     .join(it, c(f"{p}_item_sk") == c("i_item_sk"))
                     .groupBy(key).agg(F.sum(f"{p}_ext_sales_price").alias("total_sales")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy(key).agg(F.sum("total_sales").cast("decimal(38,2)").alias("total_sales"))


@register("q33")
def q33(spark, sf_dir, category="Books", year=1999, moy=3, gmt=-5):
    t = Tables(spark, sf_dir)
    g = _three_channel_sales(t, "i_manufact_id", c("i_category") == category, year, moy, gmt)
    return topk(g, ["total_sales"])


@register("q56")
def q56(spark, sf_dir, colors=("slate", "blanched", "burnished"), year=2000, moy=1, gmt=-8):
    t = Tables(spark, sf_dir)
    g = _three_channel_sales(t, "i_item_id", c("i_color").isin(list(colors)), year, moy, gmt)
    return topk(g, ["total_sales"])


@register("q60")
def q60(spark, sf_dir, category="Children", year=1999, moy=9, gmt=-6):
    t = Tables(spark, sf_dir)
    g = _three_channel_sales(t, "i_item_id", c("i_category") == category, year, moy, gmt)
    return topk(g, ["i_item_id", "total_sales"])


def _name_days(t, fact, p, cust, month_seq):
    d = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", "d_date")
    return (fact.select(f"{p}_sold_date_sk", cust).transform(t.on_days, f"{p}_sold_date_sk", d)
            .join(t.customer.select("c_customer_sk", "c_last_name", "c_first_name"), c(cust) == c("c_customer_sk"))
            .select("c_last_name", "c_first_name", "d_date").distinct())


@register("q38")
def q38(spark, sf_dir, month_seq=1164):
    """Distinct (name, day) in all three channels: INTERSECT is planned as
    semi joins on all columns over de-duplicated inputs."""
    from ...operators.sets import intersect
    t = Tables(spark, sf_dir)
    x = intersect(_name_days(t, t.store_sales, "ss", "ss_customer_sk", month_seq),
                  _name_days(t, t.catalog_sales, "cs", "cs_bill_customer_sk", month_seq),
                  _name_days(t, t.web_sales, "ws", "ws_bill_customer_sk", month_seq))
    return x.agg(F.count(F.lit(1)).alias("cnt")).limit(100)


@register("q87")
def q87(spark, sf_dir, month_seq=1188):
    from ...operators.sets import except_
    t = Tables(spark, sf_dir)
    x = except_(_name_days(t, t.store_sales, "ss", "ss_customer_sk", month_seq),
                _name_days(t, t.catalog_sales, "cs", "cs_bill_customer_sk", month_seq),
                _name_days(t, t.web_sales, "ws", "ws_bill_customer_sk", month_seq))
    return x.agg(F.count(F.lit(1)).alias("cnt"))


@register("q97")
def q97(spark, sf_dir, month_seq=1188):
    from ...operators.joins import full_coalesce
    t = Tables(spark, sf_dir)
    d = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")

    def pairs(fact, p, cust, flag):
        return (fact.select(f"{p}_sold_date_sk", cust, f"{p}_item_sk").transform(t.on_days, f"{p}_sold_date_sk", d)
                .groupBy(c(cust).alias("customer_sk"), c(f"{p}_item_sk").alias("item_sk")).agg(F.lit(1).alias(flag)))
    j = full_coalesce(pairs(t.store_sales, "ss", "ss_customer_sk", "in_s"),
                      pairs(t.catalog_sales, "cs", "cs_bill_customer_sk", "in_c"), ["customer_sk", "item_sk"])
    s, k = c("in_s").isNotNull(), c("in_c").isNotNull()
    return j.agg(F.sum(F.when(s & ~k, 1).otherwise(0)).alias("store_only"),
                 F.sum(F.when(~s & k, 1).otherwise(0)).alias("catalog_only"),
                 F.sum(F.when(s & k, 1).otherwise(0)).alias("store_and_catalog")).limit(100)


@register("q75")
def q75(spark, sf_dir, category="Books", year=2000):
    """Net sales counts per product key, this year against last year.
    The detail rows of the three channels are combined with UNION (distinct,
    as written); the year-over-year self-join becomes one aggregation with
    a conditional sum per year."""
    from ...operators.sets import union_distinct
    t = Tables(spark, sf_dir)
    it = t.item.filter(c("i_category") == category).select("i_item_sk", "i_brand_id", "i_class_id", "i_category_id",
                                                           "i_manufact_id")
    d = t.date_dim.filter(c("d_year").isin(year - 1, year)).select("d_date_sk", "d_year")
    keys = ["i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]

    def detail(sales, p, num, rets, r, rnum, amt):
        rr = rets.select(c(f"{r}_{rnum}").alias("r_num"), c(f"{r}_item_sk").alias("r_item"),
                         c(f"{r}_return_quantity").alias("r_qty"), c(f"{r}_{amt}").alias("r_amt"))
        j = (sales.join(it, c("i_item_sk") == c(f"{p}_item_sk")).transform(t.on_days, f"{p}_sold_date_sk", d)
             .join(rr, (c(f"{p}_{num}") == c("r_num")) & (c(f"{p}_item_sk") == c("r_item")), "left"))
        return j.select("d_year", *keys, (c(f"{p}_quantity") - F.coalesce(c("r_qty"), F.lit(0))).alias("sales_cnt"),
                        (c(f"{p}_ext_sales_price") - F.coalesce(c("r_amt"), F.lit(0))).alias("sales_amt"))
    u = union_distinct(detail(t.catalog_sales, "cs", "order_number", t.catalog_returns, "cr", "order_number", "return_amount"),
                       detail(t.store_sales, "ss", "ticket_number", t.store_returns, "sr", "ticket_number", "return_amt"),
                       detail(t.web_sales, "ws", "order_number", t.web_returns, "wr", "order_number", "return_amt"))
    cur, prev = c("d_year") == year, c("d_year") == year - 1
    g = u.groupBy(*keys).agg(F.sum(F.when(prev, c("sales_cnt"))).alias("prev_cnt"),
                             F.sum(F.when(cur, c("sales_cnt"))).alias("curr_cnt"),
                             F.sum(F.when(prev, c("sales_amt"))).alias("prev_amt"),
                             F.sum(F.when(cur, c("sales_amt"))).alias("curr_amt"))
    dd = "decimal(17,2)"
    g = g.filter(c("prev_cnt").isNotNull() & c("curr_cnt").isNotNull()
                 & (safe_div(c("curr_cnt").cast(dd), c("prev_cnt").cast(dd)) < 0.9))
    out = g.select(F.lit(year - 1).alias("prev_year"), F.lit(year).alias("year"), *keys,
                   c("prev_cnt").cast("bigint").alias("prev_yr_cnt"), c("curr_cnt").cast("bigint").alias("curr_yr_cnt"),
                   (c("curr_cnt") - c("prev_cnt")).cast("bigint").alias("sales_cnt_diff"),
                   (c("curr_amt") - c("prev_amt")).cast("decimal(38,2)").alias("sales_amt_diff"))
    return topk(out, ["sales_cnt_diff"])


@register("q54")
def q54(spark, sf_dir, category="Electronics", klass="dresses", year=1999, moy=3):
    """Revenue segments of customers who bought a class in catalog or web.
    The text joins each store sale to every store in the customer's county
    and state (not to the store of the sale); that multiplies each
    customer's revenue by the number of such stores, which is computed once
    per customer instead of materialising the product."""
    from ...functions.scalars import round_to_int
    from ...operators.joins import attach_scalar
    t = Tables(spark, sf_dir)
    it = t.item.filter((c("i_category") == category) & (c("i_class") == klass)).select("i_item_sk")
    d = t.date_dim.filter((c("d_moy") == moy) & (c("d_year") == year)).select("d_date_sk")
    sales = (t.in_days(t.catalog_sales, "cs_sold_date_sk", d)
             .select(c("cs_sold_date_sk").alias("sold_date_sk"), c("cs_bill_customer_sk").alias("customer_sk"), c("cs_item_sk").alias("item_sk"))
             .unionByName(t.in_days(t.web_sales, "ws_sold_date_sk", d)
                          .select(c("ws_sold_date_sk").alias("sold_date_sk"), c("ws_bill_customer_sk").alias("customer_sk"),
                                  c("ws_item_sk").alias("item_sk"))))
    my = (sales.join(d, c("sold_date_sk") == c("d_date_sk")).join(it, c("item_sk") == c("i_item_sk"))
          .join(t.customer.select("c_customer_sk", "c_current_addr_sk"), c("c_customer_sk") == c("customer_sk"))
          .select("c_customer_sk", "c_current_addr_sk").distinct())
    n_stores = (t.customer_address.select("ca_address_sk", "ca_county", "ca_state")
                .join(t.store.select("s_county", "s_state"), (c("ca_county") == c("s_county")) & (c("ca_state") == c("s_state")))
                .groupBy("ca_address_sk").agg(F.count(F.lit(1)).alias("n_stores")))
    # a keyless aggregate: exactly one row
    bounds = (t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy))
              .agg((F.min("d_month_seq") + 1).alias("lo"), (F.max("d_month_seq") + 3).alias("hi")))
    d2 = attach_scalar(t.date_dim.select("d_date_sk", "d_month_seq"), bounds) \
        .filter(c("d_month_seq").between(c("lo"), c("hi"))).select(c("d_date_sk").alias("d2_sk"))
    rev = (t.store_sales.select("ss_sold_date_sk", "ss_customer_sk", "ss_ext_sales_price")
           .transform(t.on_days, "ss_sold_date_sk", d2, "d2_sk")
           .join(my, c("c_customer_sk") == c("ss_customer_sk"))
           .groupBy("c_customer_sk", "c_current_addr_sk").agg(F.sum("ss_ext_sales_price").alias("base_rev"))
           .join(n_stores, c("c_current_addr_sk") == c("ca_address_sk"))
           .select((c("base_rev") * c("n_stores")).alias("revenue")))
    seg = rev.select(round_to_int(c("revenue") / 50).alias("segment"))
    g = seg.groupBy("segment").agg(F.count(F.lit(1)).alias("num_customers")).withColumn("segment_base", c("segment") * 50)
    return topk(g, ["segment", "num_customers"])


def default_zip_list() -> tuple[str, ...]:
    """Zip codes of the q08 list, built by rule over this repo's address
    dimension (every second of its 60 zip codes)."""
    return tuple(str(10000 + i * 311) for i in range(0, 60, 2))


@register("q08")
def q08(spark, sf_dir, zips=default_zip_list(), qoy=1, year=2000, min_preferred=1):
    """Store profit where the store's zip prefix matches a listed zip that
    also has many preferred customers (INTERSECT of the two zip sets).

    The text joins sales to the zip set on a two-character prefix, so each
    sale counts once per matching zip; the number of matching zips per
    prefix is computed on the (small) zip set and multiplied in, instead of
    expanding every sale."""
    from ...operators.sets import intersect
    t = Tables(spark, sf_dir)
    z5 = F.substring("ca_zip", 1, 5)
    listed = t.customer_address.filter(z5.isin(list(zips))).select(z5.alias("zip"))
    pref = (t.customer_address.join(t.customer.filter(c("c_preferred_cust_flag") == "Y").select("c_current_addr_sk"),
                                    c("ca_address_sk") == c("c_current_addr_sk"))
            .groupBy("ca_zip").agg(F.count(F.lit(1)).alias("cnt")).filter(c("cnt") > min_preferred)
            .select(F.substring("ca_zip", 1, 5).alias("zip")))
    v1 = intersect(listed, pref)
    per_prefix = v1.groupBy(F.substring("zip", 1, 2).alias("p2")).agg(F.count(F.lit(1)).alias("n_zip"))
    st = (t.store.select("s_store_sk", "s_store_name", F.substring("s_zip", 1, 2).alias("s_p2"))
          .join(per_prefix, c("s_p2") == c("p2")))
    j = (t.store_sales.select("ss_store_sk", "ss_sold_date_sk", "ss_net_profit")
         .transform(t.on_days, "ss_sold_date_sk", t.date_dim.filter((c("d_qoy") == qoy) & (c("d_year") == year)).select("d_date_sk"))
         .join(st, c("ss_store_sk") == c("s_store_sk")))
    g = j.groupBy("s_store_name").agg(F.sum(c("ss_net_profit") * c("n_zip")).cast("decimal(38,2)").alias("sum_net_profit"))
    return topk(g, ["s_store_name"])


def _q24(t, market, color, factor):
    """The address is matched by zip and country (not by the customer's
    address key), so one sale meets every address sharing the store's zip.
    Addresses are counted per (zip, country, state) and the count multiplies
    the sale, which gives the same sums without the product."""
    addr = (t.customer_address.groupBy(c("ca_zip").alias("a_zip"), F.upper("ca_country").alias("a_country"), "ca_state")
            .agg(F.count(F.lit(1)).alias("n_addr")))
    j = (t.store_sales.select("ss_ticket_number", "ss_item_sk", "ss_customer_sk", "ss_store_sk", "ss_sales_price")
         .join(t.store_returns.select("sr_ticket_number", "sr_item_sk"),
               (c("ss_ticket_number") == c("sr_ticket_number")) & (c("ss_item_sk") == c("sr_item_sk")))
         .join(t.store.filter(c("s_market_id") == market).select("s_store_sk", "s_store_name", "s_state", "s_zip"),
               c("ss_store_sk") == c("s_store_sk"))
         .join(t.item.select("i_item_sk", "i_color", "i_current_price", "i_manager_id", "i_units", "i_size"),
               c("ss_item_sk") == c("i_item_sk"))
         .join(t.customer.select("c_customer_sk", "c_last_name", "c_first_name", "c_birth_country"),
               c("ss_customer_sk") == c("c_customer_sk"))
         .join(addr, (c("c_birth_country") == c("a_country")) & (c("s_zip") == c("a_zip"))))
    ssales = (j.groupBy("c_last_name", "c_first_name", "s_store_name", "ca_state", "s_state", "i_color", "i_current_price",
                        "i_manager_id", "i_units", "i_size")
              .agg(F.sum(c("ss_sales_price") * c("n_addr")).alias("netpaid")))
    from ...operators.joins import attach_scalar
    avg = ssales.agg((F.lit(factor) * mean("netpaid")).alias("limit_paid"))
    g = (ssales.filter(c("i_color") == color).groupBy("c_last_name", "c_first_name", "s_store_name")
         .agg(F.sum("netpaid").alias("paid")))
    return (attach_scalar(g, avg).filter(c("paid") > c("limit_paid"))
            .select("c_last_name", "c_first_name", "s_store_name", c("paid").cast("decimal(38,2)").alias("paid")))


@register("q24a")
def q24a(spark, sf_dir, market=7, color="pale", factor=0.05):
    return _q24(Tables(spark, sf_dir), market, color, factor)


@register("q24b")
def q24b(spark, sf_dir, market=7, color="chiffon", factor=0.05):
    return _q24(Tables(spark, sf_dir), market, color, factor)
