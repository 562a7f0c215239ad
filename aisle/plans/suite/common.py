"""Shared pieces of the suite: table access and frequently repeated shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...sources.retail import fact_ranges, part_column, retail_tables


class Tables:
    """Attribute access to the 24 retail tables of one input directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._t = retail_tables(spark, sf_dir)
        self._ranges = fact_ranges(spark, sf_dir)
        self.spark = spark

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self._t[name]
        except KeyError as e:
            raise AttributeError(name) from e

    def in_days(self, fact: DataFrame, key: str, days: DataFrame, day: str = "d_date_sk") -> DataFrame:
        """``fact`` without the ranges that hold none of ``days``, if it is
        stored by ranges of its date key ``key``; else ``fact`` itself.

        The ranges of the days meet the range column in a semi join, which
        prunes folders at run time.  The column need not be selected."""
        cut = self._ranges.get(key)
        if cut is None:
            return fact
        return fact.filter(F.col(part_column(key)).isin(days.select(cut.start(day))))

    def on_days(self, fact: DataFrame, key: str, days: DataFrame, day: str = "d_date_sk") -> DataFrame:
        """Join of ``fact`` with ``days`` on its date key."""
        return self.in_days(fact, key, days, day).join(days, F.col(key) == F.col(day))
