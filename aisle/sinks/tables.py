"""Writing tables: full loads, range partitions, load by partition, storage
options, money type, hash distribution.

Range partitioning of a fact: the date key range [lo, hi] is cut into
``days``-wide ranges; each row gets ``part_start`` = first key of its
range, and every key outside the range (and NULL) goes to the
``outliers`` partition, ``part_start = -1``.  The column drives
``partitionBy``, so readers that filter on it skip whole directories.  Beside
the folders, ``_ranges`` (which readers of the table skip) says how the keys
were cut, so a statement can turn the days it asks for into ranges.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PART_LO, PART_HI = 2450815, 2453005   # 1998-01-01 .. 2003-12-31; pass the range of the data (``key_range``) where it differs
OUTLIERS = -1

# The range-partition (date) key of each fact.
PART_KEY = {"store_sales": "ss_sold_date_sk", "catalog_sales": "cs_sold_date_sk", "web_sales": "ws_sold_date_sk",
            "store_returns": "sr_returned_date_sk", "catalog_returns": "cr_returned_date_sk",
            "web_returns": "wr_returned_date_sk", "inventory": "inv_date_sk"}
# Hash-distribution keys of the facts.
DIST_KEY = {"store_sales": ["ss_item_sk", "ss_ticket_number"], "store_returns": ["sr_item_sk", "sr_ticket_number"],
            "catalog_sales": ["cs_item_sk", "cs_order_number"], "catalog_returns": ["cr_item_sk", "cr_order_number"],
            "web_sales": ["ws_item_sk", "ws_order_number"], "web_returns": ["wr_item_sk", "wr_order_number"],
            "inventory": ["inv_date_sk", "inv_item_sk", "inv_warehouse_sk"]}


def write_options(fmt: str = "parquet", row_group: int | None = None, codec: str = "snappy") -> dict:
    """Storage options: codec 'snappy' or 'none', and the row-group size in
    rows, approximated by bytes (Parquet sizes row groups in bytes); left
    out, row groups have Parquet's default of 128 MiB."""
    opts = {"compression": "none" if codec in (None, "none") else codec}
    if row_group:
        opts["parquet.block.size"] = str(max(1 << 16, int(row_group) * 128))
    return opts


def load_table(df: DataFrame, path: str, options: dict | None = None) -> None:
    """Create-or-replace a table from a reader, all columns in order."""
    w = df.write.mode("overwrite")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.parquet(path)


@dataclass(frozen=True)
class Ranges:
    """Keys from ``lo`` to ``hi`` in ranges of ``days``."""
    lo: int
    hi: int
    days: int

    def start(self, key: str):
        return part_start(key, self.days, self.lo, self.hi)


def _write_ranges(spark: SparkSession, path: str, ranges: Ranges) -> None:
    row = [(ranges.lo, ranges.hi, ranges.days)]
    spark.createDataFrame(row, "lo int, hi int, days int").coalesce(1).write.mode("overwrite").parquet(f"{path}/_ranges")


def read_ranges(spark: SparkSession, path: str) -> Ranges:
    """How the table at ``path`` was cut."""
    r = spark.read.schema("lo int, hi int, days int").parquet(f"{path}/_ranges").first()
    return Ranges(r["lo"], r["hi"], r["days"])


def part_start(key: str, days: int, lo: int = PART_LO, hi: int = PART_HI):
    k = F.col(key)
    return F.when(k.between(lo, hi), F.lit(lo) + F.floor((k - lo) / days).cast("int") * days) \
        .otherwise(F.lit(OUTLIERS)).cast("int")


def shuffle_partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle of this session starts with."""
    n = spark.conf.get("spark.sql.shuffle.partitions")
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        n = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or n
    return int(n)


ROWS_PER_SLICE = 100_000  # at least, where there are that many


def cluster_for_write(df: DataFrame, part_col: str, key: str) -> DataFrame:
    """Order rows by (partition value, key) across tasks: each task then
    writes a contiguous slice, so it touches few partition folders, and a
    large partition value is spread over several tasks instead of one
    (a plain hash repartition on the partition column would send a whole
    range, or one hot day, to a single task).

    The slices are cut by the exact rows of every key, counted from the key
    column alone: a row's place is the number of rows with smaller keys plus
    its hash among those of its own key.  (Range partitioning by all three
    would build and hash all whole rows once more, just to sample them.)"""
    n = shuffle_partitions(df.sparkSession)
    rows = F.col("_rows")
    per_key = df.groupBy(F.col(part_col).alias("_part"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per day: a window without partitions is small, and so is the broadcast
    per_key = per_key.select("_part", "_key", rows, (F.sum(rows).over(Window.orderBy("_part", "_key")) - rows).alias("_before"),
                             F.greatest(F.ceil(F.sum(rows).over(Window.partitionBy()) / n), F.lit(ROWS_PER_SLICE)).alias("_slice"))
    # a deterministic row hash breaks ties, so even one hot key value is
    # split across tasks (a random tiebreak would break on task retries)
    place = F.col("_before") + F.pmod(F.xxhash64(*df.columns), rows)
    return (df.join(F.broadcast(per_key), (F.col(part_col) == F.col("_part")) & F.col(key).eqNullSafe(F.col("_key")))
            .repartitionById(n, F.floor(place / F.col("_slice")).cast("int")).select(*df.columns))


def write_range_partitioned(df: DataFrame, key: str, days: int, path: str, lo: int = PART_LO,
                            hi: int = PART_HI, options: dict | None = None) -> None:
    """Every row lands in exactly one partition (outliers included)."""
    out = cluster_for_write(df.withColumn("part_start", part_start(key, days, lo, hi)), "part_start", key)
    w = out.write.mode("overwrite").partitionBy("part_start")
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.parquet(path)
    _write_ranges(df.sparkSession, path, Ranges(lo, hi, days))


def load_partitions(spark: SparkSession, df: DataFrame, key: str, days: int, path: str,
                    ranges: list[int] | None = None, lo: int = PART_LO, hi: int = PART_HI) -> int:
    """Load range by range: only rows inside a listed range are written.
    One job with dynamic partition overwrite instead of one job per range.
    Returns how many rows lie outside every range and were left out."""
    placed = df.withColumn("part_start", part_start(key, days, lo, hi))
    out = placed.filter(F.col("part_start") != OUTLIERS)
    if ranges is not None:
        out = out.filter(F.col("part_start").isin(list(ranges)))
    (cluster_for_write(out, "part_start", key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("part_start").parquet(path))
    _write_ranges(spark, path, Ranges(lo, hi, days))
    return placed.filter(F.col("part_start") == OUTLIERS).count()


def key_range(df: DataFrame, key: str) -> tuple[int, int]:
    """The least and the greatest value of a date key (two scalars); the
    default range where there is none."""
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    return (PART_LO, PART_HI) if lo is None else (lo, hi)


def with_money(df: DataFrame, money: str = "decimal") -> DataFrame:
    """Money columns as decimals (default) or doubles."""
    if money != "double":
        return df
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal"
                       else F.col(f.name) for f in df.schema.fields])


def distribute(df: DataFrame, cols: list[str], n: int | None = None) -> DataFrame:
    """Hash-distribute by the declared keys (co-locates sales with their
    returns when both use the same keys and partition count)."""
    return df.repartition(n, *cols) if n else df.repartition(*cols)


def save_bucketed(df: DataFrame, table: str, cols: list[str], n: int, path: str | None = None) -> None:
    """Catalog table bucketed and sorted by ``cols``: later joins on them need
    no shuffle.  Rows are dealt by the buckets' own hash first, so a bucket is
    one file.  ``path``: where its files go (else into the warehouse)."""
    w = df.repartition(n, *cols).write.mode("overwrite").format("parquet").bucketBy(n, *cols).sortBy(*cols)
    (w.option("path", path) if path else w).saveAsTable(table)


def attach_bucketed(spark: SparkSession, table: str, path: str, schema, cols: list[str], n: int) -> DataFrame:
    """The bucketed files at ``path``, which another session may have written,
    as a table of this session's catalog."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(cols)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {n} BUCKETS LOCATION '{path}'")
    return spark.table(table)
