"""Items sold in every channel (q14a, q14b) and frequent items bought by
best customers (q23a, q23b).

Shared pieces are built once per query as DataFrames: the cross-channel
item set (INTERSECT of distinct brand/class/category triples, then a semi
join back to items) and the one-row average used in HAVING (a keyless
aggregate, broadcast beside the groups).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions.scalars import mean

from ...operators.aggs import rollup_levels
from ...operators.joins import attach_scalar, semi
from ...operators.sets import intersect
from ...operators.sorts import topk
from ..registry import register
from .common import Tables

c = F.col
CHANNELS = (("store", "store_sales", "ss"), ("catalog", "catalog_sales", "cs"), ("web", "web_sales", "ws"))
KEYS = ["i_brand_id", "i_class_id", "i_category_id"]


def cross_items(t, y0):
    """Items whose (brand, class, category) sold in all three channels.  Each
    channel is first cut down to its distinct item keys, as the triples are
    few and hot; then INTERSECT of the distinct triples of those items, and a
    semi join back to the items."""
    d = t.date_dim.filter(c("d_year").between(y0, y0 + 2)).select("d_date_sk")
    it = t.item.select("i_item_sk", *KEYS)
    triples = []
    for _, tab, p in CHANNELS:
        sold = (getattr(t, tab).select(f"{p}_item_sk", f"{p}_sold_date_sk")
                .transform(t.on_days, f"{p}_sold_date_sk", d).select(c(f"{p}_item_sk").alias("sold_sk")).distinct())
        triples.append(sold.join(it, c("sold_sk") == c("i_item_sk")).select(*KEYS))
    x = intersect(*triples)
    return semi(t.item.select("i_item_sk", *KEYS), x, KEYS, KEYS).select(c("i_item_sk").alias("cross_sk"))


def avg_sales(t, store_y0, other_y0):
    """Average quantity x list price over the three channels.  The store
    branch uses a different year range from the other two in the text
    (kept)."""
    parts = []
    for name, tab, p in CHANNELS:
        y0 = store_y0 if name == "store" else other_y0
        d = t.date_dim.filter(c("d_year").between(y0, y0 + 2)).select("d_date_sk")
        parts.append(getattr(t, tab).transform(t.on_days, f"{p}_sold_date_sk", d)
                     .select((c(f"{p}_quantity") * c(f"{p}_list_price")).alias("v")))
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.agg(mean("v").alias("average_sales"))


def _channel_sales(t, label, tab, p, items, dates, avg):
    j = (getattr(t, tab).select(f"{p}_item_sk", f"{p}_sold_date_sk", f"{p}_quantity", f"{p}_list_price")
         .transform(t.on_days, f"{p}_sold_date_sk", dates)
         .join(items, c(f"{p}_item_sk") == c("cross_sk"), "left_semi")
         .join(t.item.select("i_item_sk", *KEYS), c(f"{p}_item_sk") == c("i_item_sk")))
    g = j.groupBy(*KEYS).agg(F.sum(c(f"{p}_quantity") * c(f"{p}_list_price")).alias("sales"),
                             F.count(F.lit(1)).alias("number_sales"))
    return (attach_scalar(g, avg).filter(c("sales") > c("average_sales")).drop("average_sales")
            .select(F.lit(label).alias("channel"), *KEYS, "sales", "number_sales"))


@register("q14a")
def q14a(spark, sf_dir, y0=1999, year=2000, moy=11):
    """The three channel branches of the text read their facts in one union
    (tagged by channel) and aggregate once by (channel, brand, class,
    category) before the HAVING and the rollup."""
    t = Tables(spark, sf_dir)
    items = cross_items(t, y0)
    avg = avg_sales(t, y0, y0 - 1)
    d = t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    u = None
    for label, tab, p in CHANNELS:
        x = t.in_days(getattr(t, tab), f"{p}_sold_date_sk", d).select(
            F.lit(label).alias("channel"), c(f"{p}_item_sk").alias("sk"), c(f"{p}_sold_date_sk").alias("dsk"),
            (c(f"{p}_quantity") * c(f"{p}_list_price")).alias("v"))
        u = x if u is None else u.unionByName(x)
    j = (u.join(d, c("dsk") == c("d_date_sk")).join(items, c("sk") == c("cross_sk"), "left_semi")
         .join(t.item.select("i_item_sk", *KEYS), c("sk") == c("i_item_sk")))
    g = j.groupBy("channel", *KEYS).agg(F.sum("v").alias("sales"), F.count(F.lit(1)).alias("number_sales"))
    g = attach_scalar(g, avg).filter(c("sales") > c("average_sales")).drop("average_sales")
    r = rollup_levels(g, ["channel", *KEYS], [F.sum("sales").cast("decimal(38,2)").alias("sum_sales"),
                                              F.sum("number_sales").cast("bigint").alias("sum_number_sales")], flags=False)
    return topk(r, ["channel", *KEYS])


@register("q14b")
def q14b(spark, sf_dir, y0=1999, year=1999, moy=12, dom=16):
    t = Tables(spark, sf_dir)
    items = cross_items(t, y0)
    avg = avg_sales(t, y0 - 1, y0 - 1)

    def week(y):
        wk = t.date_dim.filter((c("d_year") == y) & (c("d_moy") == moy) & (c("d_dom") == dom)).select(c("d_week_seq").alias("wk"))
        return t.date_dim.join(wk, c("d_week_seq") == c("wk"), "left_semi").select("d_date_sk")
    ty = _channel_sales(t, "store", "store_sales", "ss", items, week(year), avg)
    ly = _channel_sales(t, "store", "store_sales", "ss", items, week(year - 1), avg)
    ly = ly.select(*[c(x).alias(f"ly_{x}") for x in ly.columns])
    j = ty.join(ly, [c(k) == c(f"ly_{k}") for k in KEYS])
    out = j.select("channel", *KEYS, c("sales").cast("decimal(38,2)").alias("sales"), "number_sales",
                   "ly_channel", *[f"ly_{k}" for k in KEYS], c("ly_sales").cast("decimal(38,2)").alias("ly_sales"),
                   "ly_number_sales")
    return topk(out, ["channel", *KEYS])


def _frequent_items(t, y0, min_count):
    d = t.date_dim.filter(c("d_year").between(y0, y0 + 3)).select("d_date_sk", "d_date")
    g = (t.store_sales.select("ss_sold_date_sk", "ss_item_sk").transform(t.on_days, "ss_sold_date_sk", d)
         .join(t.item.select("i_item_sk", "i_item_desc"), c("ss_item_sk") == c("i_item_sk"))
         .groupBy(F.substring("i_item_desc", 1, 30).alias("itemdesc"), c("i_item_sk").alias("item_sk"),
                  c("d_date").alias("solddate"))
         .agg(F.count(F.lit(1)).alias("cnt")).filter(c("cnt") > min_count))
    return g.select("item_sk")


def _best_customers(t, y0, factor):
    """Customers whose all-time store spend exceeds ``factor`` x the largest
    per-customer spend in the four years (a keyless max: one row)."""
    spend = c("ss_quantity") * c("ss_sales_price")
    d = t.date_dim.filter(c("d_year").between(y0, y0 + 3)).select("d_date_sk")
    ss = t.store_sales.select("ss_customer_sk", "ss_sold_date_sk", "ss_quantity", "ss_sales_price")
    cu = t.customer.select("c_customer_sk")
    per = (t.on_days(ss, "ss_sold_date_sk", d).join(cu, c("ss_customer_sk") == c("c_customer_sk"))
           .groupBy("c_customer_sk").agg(F.sum(spend).alias("csales")))
    mx = per.agg(F.max("csales").alias("best_cmax"))
    alltime = (ss.join(cu, c("ss_customer_sk") == c("c_customer_sk"))
               .groupBy(c("c_customer_sk").alias("best_sk")).agg(F.sum(spend).alias("ssales")))
    return attach_scalar(alltime, mx).filter(c("ssales") > F.lit(factor) * c("best_cmax")).select("best_sk")


def _q23_sales(t, y0, year, moy, min_count, factor, by_name):
    freq = _frequent_items(t, y0, min_count)
    best = _best_customers(t, y0, factor)
    d = t.date_dim.filter((c("d_year") == year) & (c("d_moy") == moy)).select("d_date_sk")
    parts = []
    for tab, p in (("catalog_sales", "cs"), ("web_sales", "ws")):
        j = (getattr(t, tab).select(f"{p}_sold_date_sk", f"{p}_item_sk", f"{p}_bill_customer_sk", f"{p}_quantity",
                                    f"{p}_list_price")
             .transform(t.on_days, f"{p}_sold_date_sk", d)
             .join(freq, c(f"{p}_item_sk") == c("item_sk"), "left_semi")
             .join(best, c(f"{p}_bill_customer_sk") == c("best_sk"), "left_semi")
             .withColumn("sales", c(f"{p}_quantity") * c(f"{p}_list_price")))
        if by_name:
            j = (j.join(t.customer.select("c_customer_sk", "c_last_name", "c_first_name"),
                        c(f"{p}_bill_customer_sk") == c("c_customer_sk"))
                 .groupBy("c_last_name", "c_first_name").agg(F.sum("sales").alias("sales")))
        else:
            j = j.select("sales")
        parts.append(j)
    return parts[0].unionByName(parts[1])


@register("q23a")
def q23a(spark, sf_dir, y0=1999, year=1999, moy=1, min_count=1, factor=0.5):
    """The frequency threshold and the share of the best spend are
    parameters (the suite uses 4 and 0.95 on its own data)."""
    t = Tables(spark, sf_dir)
    u = _q23_sales(t, y0, year, moy, min_count, factor, False)
    return u.agg(F.sum("sales").cast("decimal(38,2)").alias("total_sales")).limit(100)


@register("q23b")
def q23b(spark, sf_dir, y0=1999, year=1999, moy=1, min_count=1, factor=0.5):
    t = Tables(spark, sf_dir)
    u = _q23_sales(t, y0, year, moy, min_count, factor, True)
    return topk(u.select("c_last_name", "c_first_name", c("sales").cast("decimal(38,2)").alias("sales")),
                ["c_last_name", "c_first_name", "sales"])
