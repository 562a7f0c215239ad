"""The 24 retail tables are equal in Spark and in the DuckDB prelude."""

from aisle.sources.retail import TABLES, duckdb_prelude, retail_tables
from oracle_check import duck_connect, norm


def test_views_equal(spark, sf_dir):
    t = retail_tables(spark, sf_dir)
    con = duck_connect(sf_dir)
    pre = duckdb_prelude()
    for name in TABLES:
        a = sorted(tuple(norm(v) for v in r) for r in t[name].collect())
        res = con.execute(pre + f" SELECT * FROM {name}")
        assert [d[0] for d in res.description] == t[name].columns, name
        b = sorted(tuple(norm(v) for v in r) for r in res.fetchall())
        assert a == b, name
