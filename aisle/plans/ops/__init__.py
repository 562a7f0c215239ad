"""Operator catalogue (keys ``op_*``) over the driver's order-entry tables.

Each entry exercises one operator of the suite on whole tables
(``lineitem`` as the fact, ``orders customer part supplier nation region``
as dimensions) and has a DuckDB twin written over the typed prelude of
``aisle.sources.orderentry``.
"""

from . import aggs, joins, predicates, scalars, sets, subqueries, windows  # noqa: F401
