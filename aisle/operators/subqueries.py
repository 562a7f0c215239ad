"""Decorrelated forms of the suite's subqueries.

* ``above_group_avg``: ``x > factor * (SELECT avg(x) FROM same WHERE key = outer.key)``
  becomes one aggregate by key joined back on the key.
* ``scalar``: an uncorrelated scalar subquery as a one-row DataFrame (its
  aggregate has no keys, so exactly one row; broadcast beside the outer rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mean


def group_avg(df: DataFrame, key: str, value: str, name: str = "_avg") -> DataFrame:
    return df.groupBy(F.col(key).alias(f"_g_{key}")).agg(mean(value).alias(name))


def salted(df: DataFrame, groups: DataFrame, salts: int, by: list[str]) -> tuple[DataFrame, DataFrame, Column]:
    """Spread few hot keys over ``salts`` parts: rows of ``df`` are dealt by a
    hash of the columns ``by``, each row of ``groups`` is repeated for every
    part; the returned condition belongs to the join of the two."""
    a = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    d = df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    return d, a, d["_salt"] == a["_part"]


def above_group_avg(df: DataFrame, key: str, value: str, factor, inner: DataFrame | None = None,
                    strict: bool = True, salts: int = 1) -> DataFrame:
    """Rows of ``df`` whose ``value`` exceeds ``factor`` x the average of
    ``value`` over rows of ``inner`` (default ``df``) with the same ``key``.
    ``salts`` > 1 for keys that are few and hot."""
    a = group_avg(inner if inner is not None else df, key, value)
    if salts > 1:
        df, a, part = salted(df, a, salts, df.columns)
        cond = part & (F.col(key) == a[f"_g_{key}"])
        lim = F.lit(factor) * a["_avg"]
        cond = cond & ((F.col(value) > lim) if strict else (F.col(value) >= lim))
        return df.join(a, cond).drop(f"_g_{key}", "_avg", "_salt", "_part")
    cond = (F.col(key) == a[f"_g_{key}"])
    lim = F.lit(factor) * a["_avg"]
    cond = cond & ((F.col(value) > lim) if strict else (F.col(value) >= lim))
    return df.join(a, cond).drop(f"_g_{key}", "_avg")


def scalar(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """One-row DataFrame holding an aggregate expression."""
    return df.agg(expr.alias(name))
