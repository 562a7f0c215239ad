"""Ordering and top-k.

The suite's dialect sorts NULL as the largest value (last when ascending,
first when descending); Spark's default is the opposite, so every key is
given an explicit NULL order.  Many ``ORDER BY .. LIMIT 100`` clauses do
not sort by a unique key; ``topk`` appends every remaining output column
as a trailing ascending key so the kept rows are the same on every engine
(still a valid answer of the original statement).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def asc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).asc_nulls_last()


def desc(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).desc_nulls_first()


def _key(k) -> Column:
    if isinstance(k, Column):
        return k
    if k.startswith("-"):
        return desc(k[1:])
    return asc(k)


def order(df: DataFrame, keys, tiebreak: bool = True) -> DataFrame:
    """Sort by ``keys`` ('col', '-col' for descending, or Columns)."""
    ks = [_key(k) for k in keys]
    if tiebreak:
        named = {k.lstrip("-") for k in keys if isinstance(k, str)}
        ks += [asc(c) for c in df.columns if c not in named]
    return df.orderBy(*ks)


def topk(df: DataFrame, keys, n: int = 100) -> DataFrame:
    """``ORDER BY keys LIMIT n``: planned as TakeOrderedAndProject (per-task
    top-n, then a merge of n rows per task), no full sort."""
    return order(df, keys).limit(n)
