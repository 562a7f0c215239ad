"""The driver's order-entry tables with exact types.

Money columns are stored as doubles holding at most two decimals; they are
read as ``decimal(12,2)`` so that sums are exact (and equal on every
engine).  Quantities are whole numbers (``int``), time stamps are days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TYPED = {
    "li": ("lineitem", [
        ("l_orderkey", None), ("l_partkey", None), ("l_suppkey", None), ("l_linenumber", None),
        ("l_quantity", "int"), ("l_extendedprice", "decimal(12,2)"), ("l_discount", "decimal(4,2)"),
        ("l_tax", "decimal(4,2)"), ("l_returnflag", None), ("l_linestatus", None),
        ("l_shipdate", "date")]),
    "od": ("orders", [
        ("o_orderkey", None), ("o_custkey", None), ("o_orderstatus", None),
        ("o_totalprice", "decimal(12,2)"), ("o_orderdate", "date"), ("o_orderpriority", None)]),
    "cu": ("customer", [
        ("c_custkey", None), ("c_name", None), ("c_nationkey", None),
        ("c_acctbal", "decimal(12,2)"), ("c_mktsegment", None)]),
    "pa": ("part", [
        ("p_partkey", None), ("p_name", None), ("p_brand", None), ("p_type", None),
        ("p_size", None), ("p_retailprice", "decimal(12,2)")]),
    "su": ("supplier", [
        ("s_suppkey", None), ("s_name", None), ("s_nationkey", None),
        ("s_acctbal", "decimal(12,2)")]),
    "nation": ("nation", [("n_nationkey", None), ("n_name", None), ("n_regionkey", None)]),
    "region": ("region", [("r_regionkey", None), ("r_name", None)]),
    "events": ("events", [("event_id", None), ("ts", None), ("user_id", None),
                          ("event_type", None), ("value", None)]),
}


class OrderEntry:
    """``t.li``, ``t.od``, ``t.cu``, ``t.pa``, ``t.su``, ``t.nation``, ``t.region``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _TYPED:
            raise AttributeError(name)
        table, cols = _TYPED[name]
        df = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
        return df.select(*[F.col(c).cast(t).alias(c) if t else F.col(c) for c, t in cols])


def _duck_cte(alias: str) -> str:
    table, cols = _TYPED[alias]
    sel = ", ".join(f"CAST({c} AS {t.upper()}) AS {c}" if t else c for c, t in cols)
    return f"{alias} AS (SELECT {sel} FROM {table})"


DUCK_PRELUDE = "WITH " + ",\n".join(_duck_cte(a) for a in ("li", "od", "cu", "pa", "su")) + "\n"
