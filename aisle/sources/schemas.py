"""Typed schemas of the 24 retail tables (one StructType each).

Column names, order and types come from the retail table definitions in
``retail.py`` (the same 425 columns as the suite's DDL); NOT NULL marks the
declared keys.  ``money="double"`` gives the floating-point variant of the
partitioned facts.
"""

from __future__ import annotations

from pyspark.sql import types as T

from .dialect import SPARK
from .retail import FACTS, _specs

# NOT NULL columns of the facts (dimensions: their first two
# columns, the surrogate key and the business id).
FACT_NOT_NULL = {
    "store_sales": ["ss_item_sk", "ss_ticket_number"],
    "store_returns": ["sr_item_sk", "sr_ticket_number"],
    "catalog_sales": [],
    "catalog_returns": [],
    "web_sales": ["ws_item_sk", "ws_order_number"],
    "web_returns": ["wr_item_sk", "wr_order_number"],
    "inventory": ["inv_date_sk", "inv_item_sk", "inv_warehouse_sk"],
}


def _type(t: str, money: str) -> T.DataType:
    if t == "i":
        return T.IntegerType()
    if t == "L":
        return T.LongType()
    if t == "s":
        return T.StringType()
    if t == "date":
        return T.DateType()
    p, s = t[1:].split(".")
    if money == "double":
        return T.DoubleType()
    return T.DecimalType(int(p), int(s))


def not_null(table: str) -> list[str]:
    if table in FACT_NOT_NULL:
        return FACT_NOT_NULL[table]
    cols = [n for n, _, _ in _specs(SPARK)[table].cols]
    return cols[:2]


def retail_schema(table: str, money: str = "decimal") -> T.StructType:
    """``money='double'`` applies to the facts only (the float DDL variant)."""
    m = money if table in FACTS else "decimal"
    nn = set(not_null(table))
    return T.StructType([T.StructField(n, _type(t, m), n not in nn)
                         for n, _, t in _specs(SPARK)[table].cols])


# the name used for the partitioned facts' DDL variants
fact_schema = retail_schema


def all_schemas(money: str = "decimal") -> dict[str, T.StructType]:
    from .retail import TABLES
    return {t: retail_schema(t, money) for t in TABLES}
