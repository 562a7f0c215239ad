"""Typed, reject-aware ingest of '|'-separated text.

Text layout: one record per line, fields separated by '|', an empty field
is NULL, latin-1 encoded, no quoting, no trailing separator.  A short
record is legal (missing trailing fields are NULL).  A record is
*rejected* when it has more fields than the schema, when a non-empty field
does not convert to its column type, or when a NOT NULL column is NULL.
Rejected records go to a quarantine DataFrame with the reason and the input
split (file and start of the block) they came from.

The limit (default 1 percent) holds for each input split by itself, so a
table that is good as a whole fails if one of its files is not; a split with
less than ``MIN_ROWS`` records counts as part of the table only, which must
keep the limit too.  The records of a split are read by one task, so a load
may also end while it runs (``early``): the task that has read ``MIN_ROWS``
records of a split and finds more rejects than the limit raises.

Reading: every column as a string plus one spare column ``_over`` that
catches an extra field; no corrupt-record column (Spark would flag legal
short records as corrupt); types are applied with ``try_cast`` so a bad
value becomes NULL instead of failing the task.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


MIN_ROWS = 300  # records of a split before its share of rejects counts
SPLIT = ["_file", "_block"]


class RejectLimitExceeded(RuntimeError):
    pass


def _raw_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields]
                        + [T.StructField("_over", T.StringType(), True)])


def read_raw(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|",
             encoding: str = "iso-8859-1") -> DataFrame:
    return (spark.read.schema(_raw_schema(schema))
            .option("sep", sep).option("encoding", encoding).option("quote", "\u0000")
            .option("escape", "\u0000").option("nullValue", "").option("emptyValue", "")
            .option("mode", "PERMISSIVE").option("header", "false")
            .csv(path)
            .select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")))


def typed_with_reason(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns plus ``_reject`` (NULL when the record is good), and the
    split where ``raw`` names it.  Each value is converted once, in a step of
    its own: the code of a wide table that converts it again for the reason is
    too long for the JVM to compile."""
    both = raw.select("*", *[F.col(f.name).try_cast(f.dataType).alias(f"_typed_{f.name}") for f in schema.fields])
    typed = [F.col(f"_typed_{f.name}").alias(f.name) for f in schema.fields]
    reasons: list[Column] = [F.when(F.col("_over").isNotNull(), F.lit("too many fields"))]
    for f in schema.fields:
        raw_c = F.col(f.name)
        bad = raw_c.isNotNull() & F.col(f"_typed_{f.name}").isNull()
        reasons.append(F.when(bad, F.lit(f"bad value in {f.name}")))
        if not f.nullable:
            reasons.append(F.when(raw_c.isNull(), F.lit(f"NULL in NOT NULL {f.name}")))
    return both.select(*typed, F.coalesce(*reasons).alias("_reject"), *[x for x in SPLIT if x in raw.columns])


def split_rejects(raw: DataFrame, schema: T.StructType, max_pct: float = 1.0,
                  check: bool = True, min_rows: int = MIN_ROWS) -> tuple[DataFrame, DataFrame]:
    """(good, bad), without storing them.  With ``check`` one aggregation
    counts the rejects of each split and raises ``RejectLimitExceeded``."""
    t = typed_with_reason(raw, schema)
    if check:
        check_limit(count_splits(t), max_pct, min_rows)
    return (t.filter(F.col("_reject").isNull()).drop("_reject", *SPLIT),
            t.filter(F.col("_reject").isNotNull()))


def count_splits(typed: DataFrame) -> DataFrame:
    """(_file, _block, row_count, reject_count) of each input split."""
    return typed.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("row_count"), F.count("_reject").alias("reject_count"))


def check_limit(splits: DataFrame, max_pct: float, min_rows: int = MIN_ROWS) -> None:
    """Raise if the rejects of a split with ``min_rows`` records or more, or
    those of the whole table, are above ``max_pct`` percent.  One row comes
    to the driver."""
    n, bad = F.col("row_count"), F.col("reject_count")
    above = (n >= min_rows) & (100.0 * bad / n > max_pct)
    r = splits.agg(F.sum(n).alias("n"), F.sum(bad).alias("bad"), F.count(F.when(above, 1)).alias("splits"),
                   F.max_by(F.struct(*SPLIT, n, bad), F.when(above, bad / n)).alias("worst")).first()
    if r["splits"]:
        w = r["worst"]
        raise RejectLimitExceeded(f"{r['splits']} splits above {max_pct}%, worst {w['_file']} from byte {w['_block']}: "
                                  f"{w['reject_count']} of {w['row_count']} rows rejected")
    if r["n"] and 100.0 * r["bad"] / r["n"] > max_pct:
        raise RejectLimitExceeded(f"{r['bad']} of {r['n']} rows rejected ({100.0 * r['bad'] / r['n']:.2f}% > {max_pct}%)")


def stop_early(typed: DataFrame, max_pct: float, min_rows: int = MIN_ROWS) -> DataFrame:
    """``typed`` as it is, in a job that ends as soon as a split is seen to be
    above the limit after ``min_rows`` records.  Costs one pass of the rows
    through Arrow; nothing else is held than the counts of the task's splits."""
    def watch(batches):
        seen: dict = {}
        for batch in batches:
            ends = pa.table({"f": batch.column("_file"), "b": batch.column("_block"), "bad": batch.column("_reject")}) \
                .group_by(["f", "b"]).aggregate([([], "count_all"), ("bad", "count")])
            for x in ends.to_pylist():
                n, bad = seen.get((x["f"], x["b"]), (0, 0))
                n, bad = n + x["count_all"], bad + x["bad_count"]
                seen[x["f"], x["b"]] = n, bad
                if n >= min_rows and 100.0 * bad / n > max_pct:
                    raise RejectLimitExceeded(f"{x['f']} from byte {x['b']}: {bad} of the first {n} rows rejected (limit {max_pct}%)")
            yield batch
    return typed.mapInArrow(watch, typed.schema)


def ingest(raw: DataFrame, schema: T.StructType, path: str, max_pct: float = 1.0, min_rows: int = MIN_ROWS,
           early: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good, rejected), read back from ``path``.  The text is parsed once:
    one job writes both kinds, told apart by ``_reject``, in the order they come
    (folders for each would cost a sort), and the counts for the limit come
    from what was written (``stored_splits`` shows them, also after a load
    that failed)."""
    typed = typed_with_reason(raw, schema)
    stored = T.StructType([T.StructField(f.name, f.dataType) for f in typed.schema.fields])
    if early:
        typed = stop_early(typed, max_pct, min_rows)
    typed.write.mode("overwrite").parquet(path)
    back = raw.sparkSession.read.schema(stored).parquet(path)
    check_limit(stored_splits(raw.sparkSession, path), max_pct, min_rows)
    return back.filter(F.col("_reject").isNull()).drop("_reject", *SPLIT), back.filter(F.col("_reject").isNotNull())


def stored_splits(spark: SparkSession, path: str) -> DataFrame:
    """``count_splits`` of a load stored under ``path``."""
    return count_splits(spark.read.schema("_file string, _block long, _reject string").parquet(path))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "|",
                   encoding: str = "iso-8859-1", max_pct: float = 1.0, store: str | None = None,
                   min_rows: int = MIN_ROWS, early: bool = False) -> DataFrame:
    """Good rows of a delimited text table, typed; fails above the reject
    limit.  They are stored under ``store`` (left out: a new folder under the
    shared checkpoint folder)."""
    store = store or f"{ensure_checkpoint_dir(spark)}/aisle-ingest/{uuid.uuid4().hex}"
    return ingest(read_raw(spark, path, schema, sep, encoding), schema, store, max_pct, min_rows, early)[0]


def write_delimited(df: DataFrame, path: str, sep: str = "|", compression: str = "none") -> None:
    """Inverse of ``read_delimited`` (used to stage text inputs).  A file with
    a compression that cannot be cut (gzip) is one input split."""
    (df.write.mode("overwrite").option("sep", sep).option("nullValue", "").option("emptyValue", "")
     .option("quote", "\u0000").option("escape", "\u0000").option("encoding", "iso-8859-1")
     .option("header", "false").option("compression", compression).csv(path))


def remove_text(spark: SparkSession, path: str) -> None:
    """Staged text that has been loaded, through Spark's own file system."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
