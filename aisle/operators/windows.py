"""Window shapes: share of a partition total, running frames, previous/next
period, top-k per group, and a global rank that does not move every row
into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import quotient4


def share_of(value: str, part: list[str], scale: int = 100) -> Column:
    """``value * scale / sum(value) over (partition by part)``, rounded to 4
    places exactly."""
    return quotient4(F.col(value) * scale, F.sum(value).over(Window.partitionBy(*part)))


def running(fn, value: str, part: list[str], order: list[str]) -> Column:
    w = (Window.partitionBy(*part).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return fn(value).over(w)


def prev_next(df: DataFrame, part: list[str], order: list[str], value: str,
              prev_name: str = "prev", next_name: str = "next") -> DataFrame:
    """Value of the previous and next row within the partition (``lag``/``lead``);
    equal to the self-join on ``rank +- 1`` when the order key is unique."""
    w = Window.partitionBy(*part).orderBy(*order)
    return (df.withColumn(prev_name, F.lag(value).over(w))
            .withColumn(next_name, F.lead(value).over(w)))


def topk_per_group(df: DataFrame, part: list[str], order: list[Column], k: int,
                   rank_name: str = "rk") -> DataFrame:
    """``rank() <= k`` per group; Spark inserts a per-task group limit
    (WindowGroupLimit) before the shuffle, so at most ``k`` ties per group
    and task travel."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank_name, F.rank().over(w).cast("long")).filter(F.col(rank_name) <= k)


def global_rank_top(df: DataFrame, keys: list[str], descending: list[bool], k: int,
                    rank_name: str = "rnk") -> DataFrame:
    """Rows whose global ``rank()`` (ordered by ``keys``) is at most ``k``.

    A window without PARTITION BY runs in one task over all rows.  Instead:
    count the rows of each key value (combined map-side), take the first
    ``k`` values in order, and rank those from their counts; the rows then
    meet the at most ``k`` ranked values, so ties of any number stay spread.
    """
    order = [F.col(c).desc_nulls_first() if d else F.col(c).asc_nulls_last()
             for c, d in zip(keys, descending)]
    values = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).orderBy(*order).limit(k)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # at most k rows, already in one task
    ranked = (values.withColumn(rank_name, (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("long"))
              .filter(F.col(rank_name) <= k)
              .select(*[F.col(c).alias(f"_t_{c}") for c in keys], rank_name))
    cond = [F.col(c).eqNullSafe(ranked[f"_t_{c}"]) for c in keys]
    return df.join(F.broadcast(ranked), cond).drop(*[f"_t_{c}" for c in keys])


def rank_in_groups(df: DataFrame, group: list[str], value: str, name: str = "rnk", pieces: int | None = None) -> DataFrame:
    """Adds the exact ascending ``rank()`` of every row by ``value`` within
    ``group`` (NULLs last), for a few groups of any size; with ``group`` empty,
    among all rows.

    Rows are first counted per distinct value (combined map-side, so ties of
    any number are one row).  The values of a group are dealt by about
    ``pieces`` marks, its approximate quantiles; the counts of the pieces, a
    few rows, become offsets, and a window inside a piece does the rest.  The
    ranked values then meet the rows by equality."""
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = [f"_g{i}" for i in range(len(group))]
    values = df.groupBy(*[F.col(k).alias(a) for k, a in zip(group, g)], F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    marks = values.groupBy(*[F.col(a).alias(f"{a}m") for a in g]).agg(
        F.array_distinct(F.percentile_approx("_v", [i / pieces for i in range(1, pieces)] or [0.5], 10 * pieces)).alias("_marks"))

    def same(left, right):
        cond = F.lit(True)
        for x, y in zip(left, right):
            cond = cond & F.col(x).eqNullSafe(F.col(y))
        return cond
    placed = attach_marks(values, marks, same(g, [f"{a}m" for a in g]) if g else None)
    sizes = placed.groupBy(*g, "_piece").agg(F.sum("_n").alias("_in"))
    # a few rows: one per piece
    below = Window.partitionBy(*g).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(a).alias(f"{a}s") for a in g], F.col("_piece").alias("_ps"),
                          F.coalesce(F.sum("_in").over(below), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*g, "_piece").orderBy(F.col("_v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (placed.withColumn("_before", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(starts, same([*g, "_piece"], [*[f"{a}s" for a in g], "_ps"]))
              .select(*g, "_v", (F.col("_start") + F.col("_before") + 1).cast("long").alias(name)))
    return df.join(ranked, same([*group, value], [*g, "_v"])).drop(*g, "_v")


def attach_marks(values: DataFrame, marks: DataFrame, cond: Column | None) -> DataFrame:
    """``values`` with ``_piece``: how many of its group's marks lie below the
    value, the last piece for NULL."""
    both = values.crossJoin(F.broadcast(marks)) if cond is None else values.join(marks, cond)  # one row without groups
    piece = F.when(F.col("_v").isNull(), F.size("_marks") + 1).otherwise(F.size(F.filter("_marks", lambda m: m < F.col("_v"))))
    return both.withColumn("_piece", F.coalesce(piece, F.lit(0))).drop(*marks.columns)
