"""The driver contract of __spark_entry__."""

import re

import __spark_entry__ as entry_mod


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["d_year", "brand_id", "brand", "sum_agg"]


def test_registry_consistent():
    q = entry_mod.queries()
    o = entry_mod.oracle_sql()
    assert set(o) <= set(q)
    suite = [k for k in q if k.startswith("q")]
    assert len(suite) == 103
    assert len([k for k in q if k.startswith("op_")]) >= 90
    optional = {k for k in q if re.match(r"op\d+_", k)} | {"pipeline"}
    assert set(q) - set(o) <= optional
