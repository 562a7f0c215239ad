"""Set operations with the suite's semantics.

``INTERSECT`` and ``EXCEPT`` are distinct operations (``intersect`` /
``subtract``).  Catalyst plans them as a semi / anti join with a distinct
above it, so raw rows would be shuffled; every input is therefore made
distinct first, which combines equal rows before they leave their task.
``union_all`` matches columns by name; ``union_distinct`` de-duplicates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_all(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_all(*dfs).distinct()


def intersect(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), [df.distinct() for df in dfs])


def except_(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.subtract(b), [df.distinct() for df in dfs])
