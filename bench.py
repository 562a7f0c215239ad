"""Power run of the retail suite; prints ONE JSON line.

``value`` is the sum over the 103 statements of what a client waits for: the
driver-side time to build the DataFrame plan plus the execution (every
result row produced into Spark's noop sink).  Its two parts are reported as
``plan_build_sec`` and ``execution_sec``, and the one-off derivation of the
retail tables as ``load_sec``.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPS (timed repetitions after one warm-up, default 3;
the reported time per query is the median), BENCH_SET (all | hive),
BENCH_STREAMS (default 0; > 0 adds a throughput run of that many streams).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    qset = os.environ.get("BENCH_SET", "all")
    from pyspark.sql import SparkSession
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("aisle-bench")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(cpus))  # one per core at this size; AQE coalesces
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.session.timeZone", "UTC"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="aisle-bench-"))
    from aisle.plans.runs import select_queries, time_query_parts
    from aisle.sources.retail import retail_tables

    t0 = time.perf_counter()
    list(retail_tables(spark, sf_dir).values())  # derive and store the retail tables once (the load step)
    load_sec = time.perf_counter() - t0

    keys = select_queries(set_name=qset)
    times, plan_times, run_times = {}, {}, {}
    for key in keys:
        time_query_parts(spark, key, sf_dir)  # warm-up (JIT, file listing, code generation)
        runs = [time_query_parts(spark, key, sf_dir) for _ in range(reps)]
        times[key] = round(statistics.median(sum(r) for r in runs), 4)
        plan_times[key] = statistics.median(r[0] for r in runs)
        run_times[key] = statistics.median(r[1] for r in runs)
    total = round(sum(times.values()), 3)
    extra = {}
    streams = int(os.environ.get("BENCH_STREAMS", "0"))
    if streams:  # optional throughput run: S concurrent streams over all templates
        from aisle.streaming.throughput import run_throughput
        t1 = time.perf_counter()
        run_throughput(spark, sf_dir, streams).count()
        extra = {"streams": streams, "throughput_sec": round(time.perf_counter() - t1, 3)}
    print(json.dumps({**extra, "metric": "power_run_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")), "load_sec": round(load_sec, 3),
                      "plan_build_sec": round(sum(plan_times.values()), 3),
                      "execution_sec": round(sum(run_times.values()), 3),
                      "statements": len(keys), "cpus": cpus, "reps": reps}))


if __name__ == "__main__":
    main()
