"""The few SQL spellings that differ between Spark SQL and DuckDB.

The retail views are declared once as SQL expressions (see ``retail.py``);
Spark evaluates them through ``selectExpr`` and the DuckDB oracle gets the
same text as a ``WITH`` prelude.  Everything else in those expressions is
plain ANSI (``+ - * %``, CASE, CAST, ``concat``, ``lpad``, ``substr``).
"""

from __future__ import annotations


class Dialect:
    name = "ansi"

    def div(self, a: str, b: str) -> str:
        """Integer division, truncating."""
        raise NotImplementedError

    def date_plus(self, d: str, n: str) -> str:
        """Date ``d`` plus ``n`` days."""
        raise NotImplementedError

    def days_between(self, later: str, earlier: str) -> str:
        """Whole days from ``earlier`` to ``later``."""
        raise NotImplementedError

    def to_date(self, ts: str) -> str:
        return f"CAST({ts} AS DATE)"


class SparkDialect(Dialect):
    name = "spark"

    def div(self, a, b):
        return f"(({a}) div ({b}))"

    def date_plus(self, d, n):
        return f"date_add({d}, CAST({n} AS INT))"

    def days_between(self, later, earlier):
        return f"datediff({later}, {earlier})"


class DuckDialect(Dialect):
    name = "duckdb"

    def div(self, a, b):
        return f"(({a}) // ({b}))"

    def date_plus(self, d, n):
        return f"({d} + CAST({n} AS INTEGER))"

    def days_between(self, later, earlier):
        return f"(({later}) - ({earlier}))"


SPARK = SparkDialect()
DUCK = DuckDialect()

TYPE_SQL = {
    "i": "INT",
    "L": "BIGINT",
    "s": "STRING",
    "date": "DATE",
}


def sql_type(t: str) -> str:
    """``i L s date`` or ``d7.2`` (decimal(7,2))."""
    if t.startswith("d") and t != "date":
        p, s = t[1:].split(".")
        return f"DECIMAL({p},{s})"
    return TYPE_SQL[t]
