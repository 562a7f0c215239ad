"""Command line: the workload kit's sub-commands as Spark jobs.

  python -m aisle stage  --sf-dir D --out T       write the retail tables as '|' text (one folder per table)
  python -m aisle load   --text-dir T --out P     typed ingest with rejects + reconciliation -> Parquet
  python -m aisle part   --in P --out Q --days N [--by-part]   range-partition the seven facts
  python -m aisle analyze --in P                  column statistics of every table
  python -m aisle report --in P                   files and bytes per table
  python -m aisle gen    --sf-dir D --out G --copies N         scale-out copies of the input tables
  python -m aisle query  --sf-dir D [--num 3,7 | --set hive] [--explain] [--streams S]

``--sf-dir`` may hold the order-entry tables (the retail tables are derived
from them) or the 24 retail tables themselves (as written by ``load``).
Reports are DataFrames, printed with ``show``; nothing else is collected.
"""

from __future__ import annotations

import argparse


def _session(cpus: str):
    from .session import local_session
    return local_session(cpus)


def main(argv=None):
    ap = argparse.ArgumentParser(prog="aisle")
    sub = ap.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("stage")
    s.add_argument("--sf-dir", required=True)
    s.add_argument("--out", required=True)
    s = sub.add_parser("load")
    s.add_argument("--text-dir", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--max-reject-pct", type=float, default=1.0)
    s.add_argument("--stop-early", action="store_true", help="end the load as soon as an input split is above the limit")
    s.add_argument("--money", choices=["decimal", "double"], default="decimal")
    s = sub.add_parser("part")
    s.add_argument("--in", dest="inp", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--days", type=int, required=True)
    s.add_argument("--by-part", action="store_true")
    s.add_argument("--codec", default="snappy")
    s.add_argument("--row-group", type=int, default=None)
    s = sub.add_parser("analyze")
    s.add_argument("--in", dest="inp", required=True)
    s = sub.add_parser("report")
    s.add_argument("--in", dest="inp", required=True)
    s = sub.add_parser("gen")
    s.add_argument("--sf-dir", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--copies", type=int, default=2)
    s.add_argument("--parallel", type=int, default=None)
    s = sub.add_parser("query")
    s.add_argument("--sf-dir", required=True)
    s.add_argument("--num", default=None)
    s.add_argument("--set", dest="set_name", choices=["all", "hive"], default=None)
    s.add_argument("--explain", action="store_true")
    s.add_argument("--streams", type=int, default=0)
    ap.add_argument("--cpus", default="*")
    a = ap.parse_args(argv)
    spark = _session(a.cpus)

    from .sinks import jobs, tables
    from .sources import delimited
    from .sources.retail import FACTS, TABLES, retail_tables
    from .sources.schemas import retail_schema

    if a.cmd == "stage":
        t = retail_tables(spark, a.sf_dir)
        for n in TABLES:
            delimited.write_delimited(t[n], f"{a.out}/{n}")
    elif a.cmd == "load":
        pairs, rejects = {}, {}
        for n in TABLES:
            schema = retail_schema(n, a.money)
            raw = delimited.read_raw(spark, f"{a.text_dir}/{n}", schema)
            good, rejects[n] = delimited.ingest(raw, schema, f"{a.out}/_ingested/{n}", a.max_reject_pct, early=a.stop_early)
            tables.load_table(good, f"{a.out}/{n}", tables.write_options())
            pairs[n] = (raw, spark.read.parquet(f"{a.out}/{n}"))
        jobs.reconcile(spark, pairs, rejects).show(len(TABLES), truncate=False)
    elif a.cmd == "part":
        for n in FACTS:
            df = spark.read.parquet(f"{a.inp}/{n}")
            key = tables.PART_KEY[n]
            lo, hi = tables.key_range(df, key)
            if a.by_part:
                left = tables.load_partitions(spark, df, key, a.days, f"{a.out}/{n}", lo=lo, hi=hi)
                print(f"{n}: {left} rows outside every range")
            else:
                tables.write_range_partitioned(df, key, a.days, f"{a.out}/{n}", lo=lo, hi=hi,
                                               options=tables.write_options("parquet", a.row_group, a.codec))
    elif a.cmd == "analyze":
        for n in TABLES:
            print(n)
            jobs.table_stats(spark.read.parquet(f"{a.inp}/{n}")).show(200, truncate=False)
    elif a.cmd == "report":
        jobs.storage_report(spark, a.inp).orderBy("table_name").show(100, truncate=False)
    elif a.cmd == "gen":
        for n, df in jobs.generate(spark, a.sf_dir, a.copies, a.parallel).items():
            df.write.mode("overwrite").parquet(f"{a.out}/{n}.parquet")
    elif a.cmd == "query":
        from .plans.runs import explain_query, run_power, select_queries
        if a.streams:
            from .streaming.throughput import run_throughput
            run_throughput(spark, a.sf_dir, a.streams).show(1000, truncate=False)
        elif a.explain:
            for k in select_queries(a.num, a.set_name):
                print(explain_query(spark, k, a.sf_dir).first()["plan"])
        else:
            run_power(spark, a.sf_dir, a.num, a.set_name).show(200, truncate=False)


if __name__ == "__main__":
    main()
