"""Plan shape checks on the formatted physical plans: column pruning at the
fact scans, pushed filters, bounded top-k, per-group limits, shuffle reuse
and partial aggregation under a hot key."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from aisle.plans.registry import load_all
from aisle.plans.runs import plan_summary
from aisle.sources.retail import retail_tables


def _plan(df, run=False):
    if run:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_scans_are_pruned(spark, sf_dir):
    widths = {n: len(df.columns) for n, df in retail_tables(spark, sf_dir).items()}
    reg = load_all()
    for key in ["q03", "q07", "q13", "q17", "q25", "q64", "q72", "q78", "q80"]:
        plan = _plan(reg[key].fn(spark, sf_dir))
        scans = re.findall(r"Location: InMemoryFileIndex \[[^\]]*/([a-z_]+)\]\n(?:.*\n)*?ReadSchema: struct<([^>]*)>", plan)
        assert scans, key
        for loc, schema in re.findall(r"Location: InMemoryFileIndex \[[^\]]*/([a-z_]+)\]\n(?:.*\n)*?ReadSchema: struct<([^>]*)>",
                                      plan):
            if widths.get(loc, 0) > 20:
                assert schema.count(":") < widths[loc], (key, loc)


def test_star_join_shape(spark, sf_dir):
    plan = _plan(load_all()["q03"].fn(spark, sf_dir))
    assert "TakeOrderedAndProject" in plan            # ORDER BY + LIMIT without a full sort
    assert "PushedFilters: [IsNotNull(i_manufact_id), EqualTo(i_manufact_id" in plan
    assert "partial_sum" in plan                       # map-side aggregation before the shuffle


def test_topk_per_group_uses_group_limit(spark, sf_dir):
    plan = _plan(load_all()["q67"].fn(spark, sf_dir))
    assert "WindowGroupLimit" in plan


def test_shared_subplans_are_reused(spark, sf_dir):
    plan = _plan(load_all()["q14a"].fn(spark, sf_dir), run=True)
    assert "ReusedExchange" in plan


def test_hot_key_aggregates_before_shuffle(spark):
    """A third of the rows on one key: the aggregation combines map-side,
    so the shuffle carries one partial row per key and task."""
    n = 300_000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.lit(1).alias("v"))
    g = df.groupBy("k").agg(F.sum("v").alias("s"))
    plan = _plan(g)
    assert "partial_sum" in plan and "Exchange" in plan
    assert g.filter(F.col("k") == 0).first()["s"] == n // 3


@contextlib.contextmanager
def without_broadcasts(spark):
    """Plans of the size that this code is for: nothing is small enough."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for n in names:
        spark.conf.set(n, "-1")
    try:
        yield
    finally:
        for n in names:
            spark.conf.unset(n)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _tree(df):
    """(depth, node) lines of the optimized plan."""
    return [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in _optimized(df).splitlines()]


def _children(tree, i):
    """Line numbers of the two subtrees of the join in line ``i``."""
    depth = tree[i][0]
    end = next((j for j in range(i + 1, len(tree)) if tree[j][0] <= depth), len(tree))
    first = tree[i + 1][0]
    starts = [j for j in range(i + 1, end) if tree[j][0] == first]
    return [range(a, b) for a, b in zip(starts, [*starts[1:], end])]


def test_set_operations_shuffle_distinct_rows(spark, sf_dir):
    reg = load_all()
    with without_broadcasts(spark):
        for key in ("op_intersect", "op_except", "q14a", "q38", "q87"):
            tree = _tree(reg[key].fn(spark, sf_dir))
            joins = [i for i, (_, n) in enumerate(tree) if re.match(r"Join Left(Semi|Anti)", n) and "<=>" in n]
            assert joins, key
            for i in joins:
                for side in _children(tree, i):
                    assert any(tree[j][1].startswith("Aggregate") for j in side), (key, tree[i][1])


def test_dates_filter_sales_before_returns_meet_them(spark, sf_dir):
    reg = load_all()
    with without_broadcasts(spark):
        for key in ("q40", "q78", "q80"):
            tree = _tree(reg[key].fn(spark, sf_dir))
            outer = [i for i, (_, n) in enumerate(tree) if n.startswith("Join LeftOuter")]
            assert outer, key
            for i in outer:
                left = _children(tree, i)[0]
                assert any("sold_date_sk" in tree[j][1] and tree[j][1].startswith("Join Inner") for j in left), (key, tree[i][1])


def test_one_scan_aggregate_has_no_expand(spark, sf_dir):
    assert "Expand" not in _plan(load_all()["q28"].fn(spark, sf_dir))


def test_global_rank_is_not_one_task_over_all_rows(spark, sf_dir):
    df = load_all()["op_win_rank_global"].fn(spark, sf_dir)
    assert "Window" in _plan(df) and "SinglePartition" not in _plan(df)


def test_few_hot_keys_are_salted(spark, sf_dir):
    """The detail rows of a store or a state are not hashed by it alone."""
    reg = load_all()
    with without_broadcasts(spark):
        for key, hot in (("q01", "ctr_store_sk"), ("q30", "ctr_state"), ("q81", "ctr_state"), ("q65", "ss_store_sk")):
            plan = _plan(reg[key].fn(spark, sf_dir))
            detail = [m for m in re.findall(r"hashpartitioning\(([^)]*)\)", plan) if hot in m]
            assert not [m for m in detail if re.fullmatch(rf"{hot}#\d+L?, \d+", m.strip())] or "_salt" in plan, key
            assert "_salt" in plan, key


def test_cascaded_rollups_and_ranks(spark, sf_dir):
    reg = load_all()
    for key in ("q18", "q22", "q27", "q67", "op_rollup"):
        assert "Expand" not in _plan(reg[key].fn(spark, sf_dir)), key
    counted = plan_summary(spark, "q49", sf_dir)
    assert counted["Exchange"] <= 15, counted
    plan = _plan(reg["q49"].fn(spark, sf_dir))
    assert "collect_" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # inventory is combined by item before the item's names come in
    tree = _plan(reg["q22"].fn(spark, sf_dir))
    assert "Keys [1]: [inv_item_sk" in tree
