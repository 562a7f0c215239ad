"""Registry of queries: ``key -> (callable, oracle SQL)``.

Each query is ``fn(spark, sf_dir, **params) -> DataFrame``.  Its DuckDB
twin is a SQL template file ``oracle/<key>.sql`` whose ``$name``
placeholders are filled with the same defaults as the function's keyword
parameters, so both sides always run with equal literals.  Retail
queries get the retail-table prelude (``retail.duckdb_prelude``) in front.
"""

from __future__ import annotations

import inspect
import os
import string
from collections.abc import Callable
from dataclasses import dataclass

ORACLE_DIR = os.path.join(os.path.dirname(__file__), "oracle")


@dataclass
class Entry:
    key: str
    fn: Callable
    prelude: str | None          # "retail", "ops" or None
    sql: str | Callable | None = None  # inline oracle template or its maker (else oracle/<key>.sql)
    oracle: bool = True


REGISTRY: dict[str, Entry] = {}


def register(key: str, prelude: str | None = "retail", sql: str | Callable | None = None,
             oracle: bool = True):
    def deco(fn):
        REGISTRY[key] = Entry(key, fn, prelude, sql, oracle)
        fn.key = key
        return fn
    return deco


def defaults(fn: Callable) -> dict:
    return {k: p.default for k, p in inspect.signature(fn).parameters.items()
            if p.default is not inspect.Parameter.empty}


def _sql_literal(v) -> str:
    if isinstance(v, str):
        return v.replace("'", "''")
    if isinstance(v, (list, tuple)):
        return ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in v)
    return str(v)


def _body(key: str, literals: dict | None = None) -> str | None:
    """The oracle of a key without its prelude, with its literals filled in."""
    e = REGISTRY[key]
    text = e.sql
    if callable(text):
        return text()
    if text is None:
        path = os.path.join(ORACLE_DIR, f"{key}.sql")
        if not os.path.exists(path):
            return None
        with open(path) as f:
            text = f.read()
    values = defaults(e.fn) | (literals or {})
    return string.Template(text).substitute({k: _sql_literal(v) for k, v in values.items()})


def row_count_sql(statements: list[tuple[str, dict]], columns: str = "") -> str:
    """One row per statement (key, literals): its key and its number of rows;
    for the retail prelude.  ``columns`` is SQL for further columns, in which
    {i} is the position of the statement."""
    parts = []
    for i, (key, literals) in enumerate(statements):
        body = _body(key, literals).strip()
        body = "WITH " + body[1:] if body.startswith(",") else body
        parts.append(f"SELECT {columns.format(i=i)}'{key}' AS query, count(*) AS row_count FROM ({body}) s")
    return "\nUNION ALL\n".join(parts)


def oracle_text(key: str) -> str | None:
    e = REGISTRY[key]
    body = _body(key) if e.oracle else None
    if body is None:
        return None
    if e.prelude == "retail":
        from ..sources.retail import duckdb_prelude
        return duckdb_prelude() + body
    if e.prelude == "ops":
        from ..sources.orderentry import DUCK_PRELUDE
        return DUCK_PRELUDE + body
    return body


def load_all() -> dict[str, Entry]:
    """Import every plan module so that their ``register`` calls run."""
    from . import ops, pipeline, runs  # noqa: F401
    from .suite import load_suite
    load_suite()
    return REGISTRY
