"""Table jobs: row reconciliation, column statistics, storage report,
scale-out generation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def reconcile(spark: SparkSession, pairs: dict[str, tuple[DataFrame, DataFrame]],
              rejects: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, expected, actual, rejected, ok): source rows against
    stored and rejected rows.  Each table gives one row of counts."""
    parts = []
    for table, (src, dst) in pairs.items():
        sides = [src.select(F.lit(1).alias("e"), F.lit(0).alias("a"), F.lit(0).alias("r")),
                 dst.select(F.lit(0).alias("e"), F.lit(1).alias("a"), F.lit(0).alias("r"))]
        if rejects and table in rejects:
            sides.append(rejects[table].select(F.lit(0).alias("e"), F.lit(0).alias("a"), F.lit(1).alias("r")))
        u = sides[0]
        for side in sides[1:]:
            u = u.unionByName(side)
        n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
        parts.append(u.agg(n("e").alias("expected"), n("a").alias("actual"), n("r").alias("rejected"))
                     .withColumn("table_name", F.lit(table)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.select("table_name", "expected", "actual", "rejected",
                    (F.col("expected") == F.col("actual") + F.col("rejected")).alias("ok"))


def table_stats(df: DataFrame, exact: bool = False) -> DataFrame:
    """(column_name, row_count, null_count, ndv, min_value, max_value) for every
    column, from ONE aggregation over the table.  ``exact=False`` uses
    ``approx_count_distinct`` (HyperLogLog++, bounded memory per column);
    exact distinct counts are for small tables and tests."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"_n{i}"),
                 (F.count_distinct(c) if exact else F.approx_count_distinct(c)).alias(f"_d{i}"),
                 F.min(c).cast("string").alias(f"_lo{i}"), F.max(c).cast("string").alias(f"_hi{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_rows").alias("row_count"),
                     (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"), F.col(f"_d{i}").cast("long").alias("ndv"),
                     F.col(f"_lo{i}").alias("min_value"), F.col(f"_hi{i}").alias("max_value"))
            for i, c in enumerate(cols)]
    return one.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def analyze(spark: SparkSession, table: str) -> None:
    """Catalog statistics for the optimizer (cost-based join order)."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def storage_report(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, files, bytes) per table folder under ``root``; lists the
    files through the binaryFile source reading only path and length."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))
    rel = F.regexp_extract("path", r"^.*?" + root.rstrip("/").split("/")[-1] + r"/([^/]+)/", 1)
    return files.groupBy(rel.alias("table_name")).agg(F.count(F.lit(1)).alias("files"),
                                                       F.sum("length").alias("bytes"))


DIMENSIONS = ("supplier", "nation", "region")


def generate(spark: SparkSession, sf_dir: str, copies: int = 2, parallel: int | None = None) -> dict[str, DataFrame]:
    """Scale-out generation from the given tables: ``copies`` shifted copies
    of the order-entry data (order keys, customer and part keys offset per
    copy, so every copy is a disjoint, self-consistent slice).  Each copy is
    a range row; ``explode`` multiplies rows inside the tasks, ``parallel``
    sets the partition count of the output; the ``DIMENSIONS`` are taken over
    as they are.  The output serves every statement and operator like any
    input directory."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    od = spark.read.parquet(f"{sf_dir}/orders.parquet")
    pa = spark.read.parquet(f"{sf_dir}/part.parquet")
    cu = spark.read.parquet(f"{sf_dir}/customer.parquet")
    # key spans: three scalars (one aggregate each) reach the driver
    so = od.agg(F.max("o_orderkey")).first()[0] + 1
    sp = pa.agg(F.max("p_partkey")).first()[0] + 1
    sc = cu.agg(F.max("c_custkey")).first()[0] + 1
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")

    def shifted(df, shifts):
        out = df.select("*", copy)
        for col_name, span in shifts.items():
            out = out.withColumn(col_name, F.col(col_name) + F.col("copy") * F.lit(span))
        out = out.drop("copy")
        return out.repartition(parallel) if parallel else out
    return {"lineitem": shifted(li, {"l_orderkey": so, "l_partkey": sp}),
            "orders": shifted(od, {"o_orderkey": so, "o_custkey": sc}),
            "part": shifted(pa, {"p_partkey": sp}),
            "customer": shifted(cu, {"c_custkey": sc}),
            **{n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in DIMENSIONS}}
