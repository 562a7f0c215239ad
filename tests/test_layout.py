"""Facts stored by day and by ranges of days: same results, and a date_dim
filter prunes fact partitions at run time (dynamic partition pruning)."""

import contextlib
import io
import os
import re

import oracle_check
import pytest
from pyspark.sql import functions as F

from aisle.plans.registry import load_all, oracle_text
from aisle.plans.runs import shuffled_pairs
from aisle.plans.suite.common import Tables
from aisle.sources.retail import FACTS, fact_ranges, retail_tables, stored_as

SMALL = "/root/testdata/sf0.001"


def test_date_layout_same_rows_and_dpp(spark):
    flat = retail_tables(spark, SMALL, layout="flat")
    part = retail_tables(spark, SMALL, layout="date")
    assert part["store_sales"].columns == flat["store_sales"].columns
    assert part["store_sales"].count() == flat["store_sales"].count()
    ss, dd = part["store_sales"], part["date_dim"].filter(F.col("d_moy") == 12)
    q = ss.join(dd, F.col("ss_sold_date_sk") == F.col("d_date_sk")).agg(F.sum("ss_net_paid"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    assert "dynamicpruningexpression" in buf.getvalue()
    ref = flat["store_sales"].join(flat["date_dim"].filter(F.col("d_moy") == 12),
                                   F.col("ss_sold_date_sk") == F.col("d_date_sk")).agg(F.sum("ss_net_paid"))
    assert q.first()[0] == ref.first()[0]


def _scans(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture()
def ranged(spark):
    with stored_as("range", 180):
        yield spark


def test_range_layout_holds_every_row(spark, ranged):
    flat, part = retail_tables(spark, SMALL, "flat"), retail_tables(ranged, SMALL)
    for name in FACTS:
        assert part[name].columns[:-1] == flat[name].columns
        assert part[name].drop(part[name].columns[-1]).exceptAll(flat[name]).isEmpty() and part[name].count() == flat[name].count()
    cut = fact_ranges(ranged, SMALL)["ss_sold_date_sk"]
    starts = {r[0] for r in part["store_sales"].select("ss_part_start").distinct().collect()}
    assert cut.days == 180 and all((s - cut.lo) % 180 == 0 for s in starts) and fact_ranges(spark, SMALL, "flat") == {}


@pytest.mark.parametrize("key", ["q03", "q42", "q49", "q72"])
def test_a_year_prunes_ranges(ranged, key):
    plan = _scans(load_all()[key].fn(ranged, SMALL))
    assert re.search(r"PartitionFilters: \[[^\n]*dynamicpruningexpression\(part_start#", plan), plan[:3000]


def test_pruned_scan_reads_fewer_files(ranged):
    t = Tables(ranged, SMALL)
    days = t.date_dim.filter(F.col("d_year") == 1995).select("d_date_sk")
    df = t.on_days(t.store_sales.select("ss_item_sk", "ss_sold_date_sk"), "ss_sold_date_sk", days)
    df._jdf.queryExecution().toRdd().count()
    scan = [n for n in _nodes(df._jdf.queryExecution().executedPlan()) if "part_start" in n.toString() and n.nodeName().startswith("Scan")]
    read = scan[0].metrics().apply("numPartitions").value()
    assert 0 < read <= 4 < t.store_sales.select("ss_part_start").distinct().count()


def _nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _nodes(plan.executedPlan())
    if plan.nodeName().endswith("QueryStage"):
        return _nodes(plan.plan())
    out, kids = [plan], plan.children()
    for i in range(kids.size()):
        out += _nodes(kids.apply(i))
    return out


@pytest.mark.parametrize("key", ["q02", "q05", "q14b", "q23a", "q31", "q64"]
                         if not os.environ.get("AISLE_FULL_ORACLE") else [k for k in sorted(load_all()) if k[0] == "q"])
def test_statements_in_ranges(ranged, sf_dir, key):
    con = oracle_check.duck_connect(sf_dir)
    r = oracle_check.compare(ranged, con, key, load_all()[key], oracle_text(key), sf_dir)
    assert r["ok"], r


def test_bucketed_facts_join_without_a_shuffle(spark, sf_dir):
    flat = {k: load_all()[k].fn(spark, sf_dir).collect() for k in ("q17", "q40", "q64", "q93")}
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "100k"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        with stored_as("bucket", buckets=8):
            for key, want in flat.items():
                df = load_all()[key].fn(spark, sf_dir)
                joins, shuffled = shuffled_pairs(df)
                assert joins and not shuffled, key
                assert df.collect() == want
            # the sides are large enough not to be broadcast, and meet sorted
            assert "SortMergeJoin" in _scans(load_all()["q93"].fn(spark, sf_dir))
            tables = retail_tables(spark, sf_dir)
        assert tables["store_sales"].columns == retail_tables(spark, sf_dir)["store_sales"].columns
        joins, shuffled = shuffled_pairs(load_all()["q93"].fn(spark, sf_dir))
        assert joins and shuffled  # in flat files it is
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
