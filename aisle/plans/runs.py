"""Measured runs over the suite, returned as DataFrames.

* ``run_power``: queries one after another (the power test); per query the
  wall-clock seconds of a full execution (``noop`` sink: every row is
  produced, nothing is collected to the driver), the row count and an
  order-insensitive digest.
* ``explain_query``: the formatted physical plan after one execution (AQE's
  final plan, with run-time statistics).

Only timings and plan strings pass through the driver, never query rows.
"""

from __future__ import annotations

import gc
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import load_all

# Template numbers of the "hive" query set.
HIVE_SET = [3, 7, 12, 13, 15, 17, 18, 19, 20, 21, 22, 24, 25, 26, 27, 28, 29, 31, 32, 34, 39, 40, 42, 43, 45,
            46, 48, 49, 50, 51, 52, 54, 55, 56, 58, 60, 64, 65, 66, 67, 68, 70, 71, 72, 73, 75, 76, 79, 80, 82,
            83, 84, 85, 87, 88, 89, 90, 91, 92, 93, 94, 95, 96, 97, 98]

# Templates that hold two statements.
TWO_STATEMENTS = {14: ("q14a", "q14b"), 23: ("q23a", "q23b"), 24: ("q24a", "q24b"), 39: ("q39a", "q39b")}


def statement_keys(numbers) -> list[str]:
    keys = []
    for n in numbers:
        n = int(n)
        keys.extend(TWO_STATEMENTS.get(n, (f"q{n:02d}",)))
    return keys


def select_queries(num=None, set_name=None) -> list[str]:
    """``num``: comma list or iterable of template numbers, 0 = all;
    ``set_name``: 'all' or 'hive'."""
    if set_name == "hive":
        return statement_keys(HIVE_SET)
    if num is None or set_name == "all":
        numbers = range(1, 100)
    else:
        numbers = [int(x) for x in (num.split(",") if isinstance(num, str) else num)]
        if numbers == [0]:
            numbers = range(1, 100)
    return statement_keys(numbers)


def digest(df: DataFrame) -> tuple[int, str]:
    """Row count and an order-insensitive content digest (sum of row hashes
    as an exact decimal, so it cannot overflow)."""
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    return int(r["n"]), str(r["h"])


def time_query_parts(spark: SparkSession, key: str, sf_dir: str) -> tuple[float, float]:
    """(seconds to build the DataFrame plan on the driver, seconds to execute it)."""
    t0 = time.perf_counter()
    df = load_all()[key].fn(spark, sf_dir)
    t1 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return t1 - t0, time.perf_counter() - t1


def time_query(spark: SparkSession, key: str, sf_dir: str) -> float:
    """Execution seconds (every row produced into the noop sink)."""
    return time_query_parts(spark, key, sf_dir)[1]


BROADCAST = "spark.sql.autoBroadcastJoinThreshold"
MEASURED_BROADCAST = "spark.sql.adaptive.autoBroadcastJoinThreshold"
FILE_BROADCAST = 256 << 10


@contextmanager
def measured_broadcasts(spark: SparkSession):
    """Inside, the session's broadcast threshold holds for the size that
    adaptive execution measures.  A plan knows only the bytes of a table's
    files, of which a few columns of a large dimension are a hundredth while
    their rows are many times that in the driver's memory: by that guess only
    tables of ``FILE_BROADCAST`` bytes are broadcast.  (Without adaptive
    execution nothing is measured, and the threshold stays.)"""
    before = {k: spark.conf.get(k, None) for k in (BROADCAST, MEASURED_BROADCAST)}
    given = spark.conf.get(BROADCAST)
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    try:
        if limit > FILE_BROADCAST and spark.conf.get("spark.sql.adaptive.enabled") == "true":
            if before[MEASURED_BROADCAST] is None:
                spark.conf.set(MEASURED_BROADCAST, given)
            spark.conf.set(BROADCAST, str(FILE_BROADCAST))
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def release(spark: SparkSession) -> None:
    """Let go of what ended statements left in the driver (plans, broadcast
    blocks, map outputs) and, through Spark's cleaner, of their shuffle files
    and broadcasts on the executors: Spark drops them only when the driver
    happens to collect its garbage, which until then fills its whole heap."""
    gc.collect()
    spark._jvm.System.gc()


def run_power(spark: SparkSession, sf_dir: str, num=None, set_name=None, cold: bool = True,
              with_digest: bool = False) -> DataFrame:
    """Power run: (query, seconds, rows, digest).  ``cold`` drops Spark's
    cache before each query (the operating system's page cache is not
    touched); the digest costs a second execution."""
    reg = load_all()
    out = []
    with measured_broadcasts(spark):
        for key in select_queries(num, set_name):
            if cold:
                spark.catalog.clearCache()
            t0 = time.perf_counter()
            rows = observed_rows(reg[key].fn(spark, sf_dir))
            sec = time.perf_counter() - t0
            dig = digest(reg[key].fn(spark, sf_dir))[1] if with_digest else None
            out.append((key, float(sec), rows, dig))
            release(spark)
    return spark.createDataFrame(out, "query string, seconds double, rows long, digest string")


def observed_rows(df: DataFrame) -> int:
    """Run ``df`` into the noop sink and return how many rows it produced."""
    from pyspark.sql import Observation
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return int(seen.get["rows"])


def final_plan(spark: SparkSession, key: str, sf_dir: str, run: bool = True) -> str:
    """Run a statement once and return the formatted plan it ended with
    (without ``run``: the plan as built)."""
    import contextlib
    import io
    df = load_all()[key].fn(spark, sf_dir)
    if run:
        run_in_place(df)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def explain_query(spark: SparkSession, key: str, sf_dir: str) -> DataFrame:
    """(query, plan): the formatted final plan."""
    return spark.createDataFrame([(key, final_plan(spark, key, sf_dir))], "query string, plan string")


def run_in_place(df: DataFrame) -> None:
    """Execute this very DataFrame (its own query execution, so that the
    adaptive plan it reports afterwards is the final one); its rows are
    counted inside the tasks and stay in the JVM."""
    df._jdf.queryExecution().toRdd().count()


# Registered forms of the runs.  Seconds vary, so they leave out the times:
# what is compared is which statements ran and how many rows each returned.
from .registry import register, row_count_sql  # noqa: E402


def _all_statements():
    return [(k, {}) for k in select_queries(set_name="all")]


@register("run_power", sql=lambda: "SELECT * FROM (" + row_count_sql(_all_statements()) + ") r")
def run_power_all(spark, sf_dir, set_name="all"):
    """Power run over all 103 statements: (query, row_count)."""
    return run_power(spark, sf_dir, set_name=set_name).select("query", F.col("rows").alias("row_count"))


@register("run_explain", prelude=None, sql="""
SELECT * FROM (VALUES ('q03', 3), ('q07', 5), ('q42', 3), ('q52', 3), ('q55', 3), ('q96', 4)) t(query, tables_read)""")
def run_explain(spark, sf_dir, keys=("q03", "q07", "q42", "q52", "q55", "q96")):
    """Final plans of some statements, reduced to what does not vary: how many
    tables each one scans."""
    import re
    rows = [(k, len(set(re.findall(r"Scan parquet\s+\((\d+)\)", final_plan(spark, k, sf_dir).split("== Initial Plan ==")[0]))))
            for k in keys]
    return spark.createDataFrame(rows, "query string, tables_read int")


RANGED = ["q03", "q25", "q42", "q49", "q72", "q98"]


@register("run_range_layout", sql=lambda: "SELECT query, row_count, TRUE AS prunes FROM ("
          + row_count_sql([(k, {}) for k in RANGED]) + ") r")
def run_range_layout(spark, sf_dir, days=180):
    """Statements over facts that are stored by ranges of days: rows, and
    whether the fact scans leave out ranges at run time."""
    import re

    from ..sources.retail import stored_as
    rows = []
    for key in RANGED:
        with stored_as("range", days):
            df = load_all()[key].fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((key, observed_rows(df), re.search(r"dynamicpruningexpression\(part_start#", plan) is not None))
    return spark.createDataFrame(rows, "query string, row_count long, prunes boolean")


COLOCATED = ["q17", "q25", "q29", "q40", "q49", "q50", "q64", "q80", "q93"]
_SALES = {"store_returns": "store_sales", "catalog_returns": "catalog_sales", "web_returns": "web_sales"}


def plan_nodes(plan) -> list:
    """The nodes of a physical plan (of an adaptive one: as it stands), each
    with the list of its inputs: (name, node, inputs)."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return plan_nodes(plan.executedPlan())
    if name.endswith("QueryStage"):
        return plan_nodes(plan.plan())
    if name == "ReusedExchange":
        return plan_nodes(plan.child())
    kids = plan.children()
    return [(name, plan, [plan_nodes(kids.apply(i)) for i in range(kids.size())])]


def shuffled_pairs(df: DataFrame) -> tuple[int, int]:
    """Joins of a sale scan with the scan of its returns, and those of them
    with a shuffle between a scan and the join."""
    import re
    joins = shuffled = 0

    def walk(node):
        """Tables scanned below the node, and whether a shuffle is between."""
        nonlocal joins, shuffled
        name, plan, inputs = node
        below = [{k: v for n in side for k, v in walk(n).items()} for side in inputs]
        if name.startswith("Scan"):
            return {m[1]: False for m in [re.search(r"(store|catalog|web)_(?:sales|returns)", plan.relation().location().rootPaths().toString())] if m
                    for m in [re.search(r"((?:store|catalog|web)_(?:sales|returns))", m[0])]}
        if name == "Exchange":
            return {t: True for t in below[0]}
        if "Join" in name and len(below) == 2:
            for a, b in (below, below[::-1]):
                for t in a.keys() & _SALES.keys():
                    if _SALES[t] in b:
                        joins += 1
                        shuffled += a[t] or b[_SALES[t]]
                        return {}
        return {k: v for side in below for k, v in side.items()}
    for root in plan_nodes(df._jdf.queryExecution().executedPlan()):
        walk(root)
    return joins, shuffled


@register("run_bucket_layout", sql=lambda: "SELECT query, row_count, TRUE AS colocated FROM ("
          + row_count_sql([(k, {}) for k in COLOCATED]) + ") r")
def run_bucket_layout(spark, sf_dir, buckets=8, broadcast=None):
    """Statements that join sales with their returns, over facts bucketed by
    the keys of both: rows, and whether each such join has no shuffle below.
    ``broadcast``: another broadcast threshold for the run."""
    from ..sources.retail import stored_as
    conf = {"spark.sql.requireAllClusterKeysForCoPartition": "false"} | ({"spark.sql.autoBroadcastJoinThreshold": broadcast} if broadcast else {})
    before = {k: spark.conf.get(k) for k in conf}
    rows = []
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for key in COLOCATED:
            with stored_as("bucket", buckets=buckets):
                df = load_all()[key].fn(spark, sf_dir)
            joins, shuffled = shuffled_pairs(df)
            rows.append((key, observed_rows(df), joins > 0 and not shuffled))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.createDataFrame(rows, "query string, row_count long, colocated boolean")


def _stream_statements(streams=2):
    from ..streaming.throughput import statements_of
    return [(s, k, lit) for s in range(streams) for k, lit in statements_of(s)]


def _throughput_sql():
    rows = _stream_statements()
    parts = [row_count_sql([(k, lit)], f"{s} AS stream, ") for s, k, lit in rows]
    return "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") r"


@register("run_throughput", sql=_throughput_sql)
def run_throughput_all(spark, sf_dir, streams=2):
    """Two concurrent streams over all 99 templates, each with literals of
    its own: (stream, query, row_count)."""
    from ..streaming.throughput import run_throughput
    return run_throughput(spark, sf_dir, streams=streams).select("stream", "query", F.col("rows").alias("row_count"))


PLAN_NODES = ["Exchange", "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin",
              "ShuffledHashJoin", "BroadcastNestedLoopJoin", "TakeOrderedAndProject", "WindowGroupLimit",
              "Window", "Expand", "HashAggregate"]


def plan_summary(spark: SparkSession, key: str, sf_dir: str, run: bool = True) -> dict:
    """Operator counts of the plan of one statement (``final_plan``): shuffles,
    broadcasts, join strategies, top-k."""
    import re
    text = final_plan(spark, key, sf_dir, run)
    final = text.split("== Initial Plan ==")[0]
    tree = final.split("\n\n")[0]
    counts = {n: len(re.findall(rf"[+\- ]{re.escape(n)}(?: [A-Za-z]+)* \(", tree)) for n in PLAN_NODES}
    return {"query": key, **counts}
