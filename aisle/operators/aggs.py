"""Aggregation shapes: conditional sums (pivot by CASE), lag buckets,
rollup with grouping flags, and several scalar aggregates in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cond_sum(cond: Column, value, otherwise=None) -> Column:
    """``sum(CASE WHEN cond THEN value [ELSE otherwise] END)``."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.when(cond, v)
    if otherwise is not None:
        w = w.otherwise(otherwise)
    return F.sum(w)


def pivot_sums(keycol, cases: dict, value) -> list[Column]:
    """One conditional sum per ``{alias: key value}`` (the suite's hand pivot)."""
    k = F.col(keycol) if isinstance(keycol, str) else keycol
    return [cond_sum(k == v, value).alias(a) for a, v in cases.items()]


def lag_buckets(diff: Column, bounds=(30, 60, 90, 120), names=None) -> list[Column]:
    """Counts of ``diff <= b1``, ``b1 < diff <= b2`` ... and ``> last``."""
    names = names or ([f"d{bounds[0]}"] + [f"d{a + 1}_{b}" for a, b in zip(bounds, bounds[1:])]
                      + [f"d_gt{bounds[-1]}"])
    cols = [F.sum(F.when(diff <= bounds[0], 1).otherwise(0)).alias(names[0])]
    for (lo, hi), n in zip(zip(bounds, bounds[1:]), names[1:]):
        cols.append(F.sum(F.when((diff > lo) & (diff <= hi), 1).otherwise(0)).alias(n))
    cols.append(F.sum(F.when(diff > bounds[-1], 1).otherwise(0)).alias(names[-1]))
    return cols


def rollup_levels(df: DataFrame, keys: list[str], aggs: list[Column],
                  flags: bool = True) -> DataFrame:
    """``GROUP BY ROLLUP(keys)`` with integer ``g_<key>`` grouping flags and
    ``lochierarchy`` (sum of flags).

    Spark plans the rollup as one Expand feeding a partial aggregate, so the
    expanded rows are combined map-side before the shuffle.  The grand-total
    row comes from a keyless aggregate instead: SQL's ROLLUP returns it even
    over an empty input (Spark's Expand would return no row at all)."""
    full = (1 << len(keys)) - 1
    r = df.rollup(*keys).agg(*aggs, F.grouping_id().alias("_gid"))
    agg_cols = [c for c in r.columns if c not in keys and c != "_gid"]
    levels = r.filter(F.col("_gid") != full)
    total = df.agg(*aggs).select(*[F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys], *agg_cols,
                                 F.lit(full).cast(levels.schema["_gid"].dataType).alias("_gid"))
    g = levels.unionByName(total)
    if flags:
        for i, k in enumerate(keys):
            bit = 1 << (len(keys) - 1 - i)
            g = g.withColumn(f"g_{k}", ((F.col("_gid").cast("long").bitwiseAND(bit)) > 0).cast("int"))
        lvl = F.lit(0)
        for k in keys:
            lvl = lvl + F.col(f"g_{k}")
        g = g.withColumn("lochierarchy", lvl)
    return g.drop("_gid")


def rollup_cascade(df: DataFrame, keys: list[str], sums: dict[str, str], deal: int = 0) -> DataFrame:
    """``GROUP BY ROLLUP(keys)`` of sums (new name -> column) with the integer
    flags ``g_<key>`` and without an Expand: each level is aggregated from a
    finer one, and the finest from ``df``, combined map-side.

    The groups of the finest level are dealt once by the first ``deal`` keys;
    the levels that hold those keys need no further shuffle, and the coarser
    ones are aggregated from the last of these.  ``deal`` should end at a key
    of many values: a group's rows are at most its finer groups, however many
    rows of ``df`` it has.  With 0, every level comes from the next finer one.
    The branches share the dealt rows (a reused exchange).  The grand total is
    a keyless aggregate, so an empty input has that one row."""
    fine = df.groupBy(*keys).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    if deal:
        fine = fine.repartition(*keys[:deal])
    types = {f.name: f.dataType for f in fine.schema.fields}
    out, finer = None, fine
    for j in range(len(keys), -1, -1):
        if j < len(keys):
            source = fine if deal and j >= deal else finer
            finer = source.groupBy(*keys[:j]).agg(*[F.sum(n).alias(n) for n in sums])
        level = finer.select(*keys[:j], *[F.lit(None).cast(types[k]).alias(k) for k in keys[j:]],
                             *[F.col(n).cast(types[n]).alias(n) for n in sums],
                             *[F.lit(int(i >= j)).alias(f"g_{k}") for i, k in enumerate(keys)])
        out = level if out is None else out.unionByName(level)
    return out
