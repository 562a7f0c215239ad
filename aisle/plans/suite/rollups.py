"""Rollup group: subtotals with grouping flags, ranks inside rollup levels.

Plan rule used throughout: aggregate on the full key first, then roll up
the aggregate.  Sums and counts compose; averages are carried as (sum,
count) and divided after the rollup.  Where the groups are many (q18 q22 q27
q67) each level is aggregated from a finer one (``rollup_cascade``); where
they are few, the rollup's Expand multiplies those few.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ...functions.scalars import quotient4
from ...operators.aggs import rollup_cascade, rollup_levels
from ...operators.sorts import asc, desc, topk
from ...operators.windows import topk_per_group
from ..registry import register
from .common import Tables

c = F.col


def _avg_rollup(df, keys, values, first=None):
    """Rollup of averages as sums and counts, dealt by the first key, which
    has many values.  ``first``: columns by which ``df`` is combined, and a
    function that then brings in the keys."""
    if first is None:
        pairs = df.select(*keys, *[F.col(v).alias(f"_s{i}") for i, v in enumerate(values)],
                          *[F.col(v).isNotNull().cast("long").alias(f"_n{i}") for i, v in enumerate(values)])
        return rollup_cascade(pairs, keys, {f"_{x}{i}": f"_{x}{i}" for x in "sn" for i in range(len(values))}, deal=1)
    by, then = first
    pre = df.groupBy(*by).agg(*[F.sum(v).alias(f"_s{i}") for i, v in enumerate(values)],
                              *[F.count(v).alias(f"_n{i}") for i, v in enumerate(values)])
    both = [f"_{x}{i}" for x in "sn" for i in range(len(values))]
    return rollup_cascade(then(pre), keys, {n: n for n in both}, deal=1)


def _avg_col(i, name):
    return quotient4(c(f"_s{i}"), c(f"_n{i}")).alias(name)


@register("q67")
def q67(spark, sf_dir, month_seq=1188, k=100):
    t = Tables(spark, sf_dir)
    keys = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]
    dt = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk", "d_year", "d_qoy", "d_moy")
    j = (t.store_sales.select("ss_sold_date_sk", "ss_item_sk", "ss_store_sk", "ss_sales_price", "ss_quantity")
         .transform(t.on_days, "ss_sold_date_sk", dt)
         .join(t.store.select("s_store_sk", "s_store_id"), c("ss_store_sk") == c("s_store_sk"))
         .join(t.item.select("i_item_sk", "i_category", "i_class", "i_brand", "i_product_name"),
               c("ss_item_sk") == c("i_item_sk")))
    j = j.select(*keys, F.coalesce(c("ss_sales_price") * c("ss_quantity"), F.lit(0)).alias("s"))
    r = rollup_cascade(j, keys, {"sumsales": "s"}, deal=4).select(*keys, c("sumsales").cast("decimal(38,2)").alias("sumsales"))
    r = topk_per_group(r, ["i_category"], [desc("sumsales")], k)
    return topk(r, keys + ["sumsales", "rk"])


@register("q18")
def q18(spark, sf_dir, gender="M", education="College", months=(9, 5, 12, 4, 1, 10), year=2001,
        states=("TN", "GA", "TX")):
    t = Tables(spark, sf_dir)
    cd1 = t.customer_demographics.filter((c("cd_gender") == gender) & (c("cd_education_status") == education)) \
        .select(c("cd_demo_sk").alias("cd1_sk"), c("cd_dep_count").alias("cd1_dep"))
    cd2 = t.customer_demographics.select(c("cd_demo_sk").alias("cd2_sk"))
    cu = t.customer.filter(c("c_birth_month").isin(list(months))).select(
        "c_customer_sk", "c_current_cdemo_sk", "c_current_addr_sk", "c_birth_year")
    ca = t.customer_address.filter(c("ca_state").isin(list(states))).select(
        "ca_address_sk", "ca_country", "ca_state", "ca_county")
    j = (t.catalog_sales.transform(t.on_days, "cs_sold_date_sk", t.date_dim.filter(c("d_year") == year).select("d_date_sk"))
         .join(t.item.select("i_item_sk", "i_item_id"), c("cs_item_sk") == c("i_item_sk"))
         .join(cd1, c("cs_bill_cdemo_sk") == c("cd1_sk"))
         .join(cu, c("cs_bill_customer_sk") == c("c_customer_sk"))
         .join(cd2, c("c_current_cdemo_sk") == c("cd2_sk"))
         .join(ca, c("c_current_addr_sk") == c("ca_address_sk")))
    d = "decimal(12,2)"
    vals = [c("cs_quantity").cast(d), c("cs_list_price").cast(d), c("cs_coupon_amt").cast(d),
            c("cs_sales_price").cast(d), c("cs_net_profit").cast(d), c("c_birth_year").cast(d), c("cd1_dep").cast(d)]
    keys = ["i_item_id", "ca_country", "ca_state", "ca_county"]
    r = _avg_rollup(j.select(*keys, *[v.alias(f"v{i}") for i, v in enumerate(vals)]), keys,
                    [f"v{i}" for i in range(len(vals))])
    out = r.select(*keys, *[_avg_col(i, f"agg{i + 1}") for i in range(len(vals))])
    return topk(out, ["ca_country", "ca_state", "ca_county", "i_item_id"])


@register("q22")
def q22(spark, sf_dir, month_seq=1188):
    t = Tables(spark, sf_dir)
    keys = ["i_product_name", "i_brand", "i_class", "i_category"]
    # by item before its four names come in
    j = (t.inventory.transform(t.on_days, "inv_date_sk", t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk"))
         .join(t.warehouse.select("w_warehouse_sk"), c("inv_warehouse_sk") == c("w_warehouse_sk")))
    names = t.item.select("i_item_sk", *keys)
    r = _avg_rollup(j, keys, ["inv_quantity_on_hand"],
                    (["inv_item_sk"], lambda pre: pre.join(names, c("inv_item_sk") == c("i_item_sk"))))
    # the rows are chosen by the exact average and then rounded
    first = topk(r.select(*keys, (c("_s0").cast("double") / c("_n0")).alias("qoh"), quotient4("_s0", "_n0").alias("qoh4")), ["qoh", *keys])
    return first.withColumn("qoh", c("qoh4")).drop("qoh4")


@register("q27")
def q27(spark, sf_dir, gender="F", marital="D", education="College", year=1998,
        states=("TN", "TN", "TN", "TN", "TN", "TN")):
    t = Tables(spark, sf_dir)
    cd = t.customer_demographics.filter((c("cd_gender") == gender) & (c("cd_marital_status") == marital)
                                        & (c("cd_education_status") == education)).select("cd_demo_sk")
    j = (t.store_sales.transform(t.on_days, "ss_sold_date_sk", t.date_dim.filter(c("d_year") == year).select("d_date_sk"))
         .join(t.item.select("i_item_sk", "i_item_id"), c("ss_item_sk") == c("i_item_sk"))
         .join(t.store.filter(c("s_state").isin(list(states))).select("s_store_sk", "s_state"),
               c("ss_store_sk") == c("s_store_sk"))
         .join(cd, c("ss_cdemo_sk") == c("cd_demo_sk")))
    vals = ["ss_quantity", "ss_list_price", "ss_coupon_amt", "ss_sales_price"]
    r = _avg_rollup(j, ["i_item_id", "s_state"], vals)
    out = r.select("i_item_id", "s_state", c("g_s_state").alias("g_state"),
                   *[_avg_col(i, f"agg{i + 1}") for i in range(len(vals))])
    return topk(out, ["i_item_id", "s_state"])


def _rank_in_parent(r, k1, k2, measure, ascending):
    """``rank() over (partition by grouping(k1)+grouping(k2), case when
    grouping(k2) = 0 then k1 end order by measure)`` on rollup output."""
    w = Window.partitionBy("lochierarchy", F.when(c(f"g_{k2}") == 0, c(k1))).orderBy(
        asc(measure) if ascending else desc(measure))
    return r.withColumn("rank_within_parent", F.rank().over(w).cast("long"))


def _parent_order(r, k1):
    return topk(r, [desc("lochierarchy"), asc(F.when(c("lochierarchy") == 0, c(k1))), asc("rank_within_parent")])


@register("q36")
def q36(spark, sf_dir, year=2000, states=("TN",) * 8):
    t = Tables(spark, sf_dir)
    j = (t.store_sales.transform(t.on_days, "ss_sold_date_sk", t.date_dim.filter(c("d_year") == year).select("d_date_sk"))
         .join(t.item.select("i_item_sk", "i_category", "i_class"), c("ss_item_sk") == c("i_item_sk"))
         .join(t.store.filter(c("s_state").isin(list(states))).select("s_store_sk"), c("ss_store_sk") == c("s_store_sk")))
    pre = j.groupBy("i_category", "i_class").agg(F.sum("ss_net_profit").alias("p"), F.sum("ss_ext_sales_price").alias("s"))
    r = rollup_levels(pre, ["i_category", "i_class"], [F.sum("p").alias("p"), F.sum("s").alias("s")])
    r = r.withColumn("gross_margin", c("p").cast("double") / c("s").cast("double")).withColumn("margin4", quotient4("p", "s"))
    r = _rank_in_parent(r, "i_category", "i_class", "gross_margin", True)  # on the exact ratio
    out = r.select(c("margin4").alias("gross_margin"), "i_category", "i_class", "lochierarchy", "rank_within_parent")
    return _parent_order(out, "i_category")


@register("q70")
def q70(spark, sf_dir, month_seq=1188, k=5):
    """The IN list ranks states inside a window partitioned by the state
    itself, so every state ranks 1 and qualifies (kept as written)."""
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    base = (t.store_sales.select("ss_sold_date_sk", "ss_store_sk", "ss_net_profit")
            .transform(t.on_days, "ss_sold_date_sk", dt)
            .join(t.store.select("s_store_sk", "s_state", "s_county"), c("s_store_sk") == c("ss_store_sk")))
    per_state = base.groupBy(c("s_state").alias("top_state")).agg(F.sum("ss_net_profit").alias("tp"))
    ranked = per_state.withColumn("ranking", F.rank().over(Window.partitionBy("top_state").orderBy(desc("tp"))))
    top = ranked.filter(c("ranking") <= k).select("top_state")
    j = base.join(top, c("s_state") == c("top_state"), "left_semi")
    pre = j.groupBy("s_state", "s_county").agg(F.sum("ss_net_profit").alias("p"))
    r = rollup_levels(pre, ["s_state", "s_county"], [F.sum("p").cast("decimal(38,2)").alias("total_sum")])
    r = _rank_in_parent(r, "s_state", "s_county", "total_sum", False)
    out = r.select("total_sum", "s_state", "s_county", "lochierarchy", "rank_within_parent")
    return _parent_order(out, "s_state")


@register("q86")
def q86(spark, sf_dir, month_seq=1188):
    t = Tables(spark, sf_dir)
    dt = t.date_dim.filter(c("d_month_seq").between(month_seq, month_seq + 11)).select("d_date_sk")
    j = (t.web_sales.select("ws_sold_date_sk", "ws_item_sk", "ws_net_paid")
         .transform(t.on_days, "ws_sold_date_sk", dt)
         .join(t.item.select("i_item_sk", "i_category", "i_class"), c("i_item_sk") == c("ws_item_sk")))
    pre = j.groupBy("i_category", "i_class").agg(F.sum("ws_net_paid").alias("p"))
    r = rollup_levels(pre, ["i_category", "i_class"], [F.sum("p").cast("decimal(38,2)").alias("total_sum")])
    r = _rank_in_parent(r, "i_category", "i_class", "total_sum", False)
    out = r.select("total_sum", "i_category", "i_class", "lochierarchy", "rank_within_parent")
    return _parent_order(out, "i_category")
