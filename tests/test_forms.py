"""Form equality: the rewritten Spark plans against the literal statement
text run on Spark itself (one-pass aggregates vs many scalar subqueries,
lag/lead vs rank self-join, anti join vs left join + IS NULL, moment
pre-aggregation vs the many-to-many join)."""

import os
import string

import pytest

from aisle.plans.registry import ORACLE_DIR, _sql_literal, defaults, load_all
from aisle.sources.retail import TABLES, retail_tables
from oracle_check import norm


def literal_sql(key):
    e = load_all()[key]
    with open(os.path.join(ORACLE_DIR, f"{key}.sql")) as f:
        body = string.Template(f.read()).substitute({k: _sql_literal(v) for k, v in defaults(e.fn).items()})
    body = body.replace("//", " div ")
    if body.lstrip().startswith(","):
        body = "WITH " + body.lstrip()[1:]
    return body


@pytest.mark.parametrize("key", ["q09", "q28", "q88", "q90", "q47", "q78", "q17", "q25", "q04", "q31", "q39a"])
def test_rewrite_equals_literal(spark, sf_dir, key):
    t = retail_tables(spark, sf_dir)
    for n in TABLES:
        t[n].createOrReplaceTempView(n)
    fast = load_all()[key].fn(spark, sf_dir)
    lit = spark.sql(literal_sql(key))
    a = sorted(tuple(norm(v) for v in r) for r in fast.collect())
    b = sorted(tuple(norm(v) for v in r) for r in lit.collect())
    assert len(a) > 0
    assert a == b
