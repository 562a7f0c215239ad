"""Run registered queries in Spark and their DuckDB twins; compare results.

Mirrors the driver's gate: row count, column names and an order-insensitive
comparison of values (floats compared after rounding to 6 significant
digits).  Usage: ``python tests/oracle_check.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])

STRICT = not __import__("os").environ.get("AISLE_LOOSE_FLOATS")

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for n in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM read_parquet('{sf_dir}/{n}.parquet')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v) if STRICT else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral() else str(v.normalize())
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


def type_diffs(sdf, description):
    duck = {d[0]: str(d[1]) for d in description}
    out = []
    for f in sdf.schema.fields:
        t = f.dataType.simpleString()
        if duck.get(f.name) != SPARK_TO_DUCK.get(t, t.upper()):
            out.append((f.name, t, duck.get(f.name)))
    return out


def compare(spark, con, key, entry, sql, sf_dir):
    t = time.time()
    df = entry.fn(spark, sf_dir)
    srows = df.collect()
    scols = df.columns
    ts = time.time() - t
    if sql is None:
        return dict(key=key, ok=None, spark_rows=len(srows), sec=ts)
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    a = sorted(tuple(norm(v) for v in r) for r in srows)
    b = sorted(tuple(norm(v) for v in r) for r in drows)
    types = type_diffs(df, res.description)
    ok = a == b and scols == dcols and not types
    out = dict(key=key, ok=ok, spark_rows=len(srows), duck_rows=len(drows), sec=round(ts, 2))
    if types:
        out["types"] = types
    if not ok:
        out["cols"] = (scols, dcols) if scols != dcols else "same"
        sa, sb = set(a), set(b)
        out["spark_only"] = sorted(sa - sb)[:3]
        out["duck_only"] = sorted(sb - sa)[:3]
    return out


def main(argv):
    from aisle.plans.registry import load_all, oracle_text
    from aisle.session import local_session
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [k for k in argv[1:] if not k.startswith("/")]
    reg = load_all()
    spark = local_session()
    con = duck_connect(sf_dir)
    bad = []
    for key in keys or sorted(reg):
        try:
            r = compare(spark, con, key, reg[key], oracle_text(key), sf_dir)
        except Exception as e:  # noqa: BLE001
            r = dict(key=key, ok=False, error=str(e)[:600])
        print(r, flush=True)
        if r.get("ok") is False:
            bad.append(key)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
