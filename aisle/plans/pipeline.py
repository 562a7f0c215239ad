"""Table pipeline as registered jobs: text ingest with reject
handling, loads, range partitions, storage options, statistics,
reconciliation and scale-out generation.

Inputs are the retail tables derived from the driver's tables; text and
table outputs are staged under ``spark.checkpoint.dir`` (shared storage on
a cluster) in a folder of their own for each run, so concurrent runs never
read what another one is replacing.  Each job returns a DataFrame read back
from what it wrote, so the check covers the round trip.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from ..sinks import jobs, tables
from ..sources import delimited
from ..sources.retail import FACTS, TABLES, _checkpoint_root, _fingerprint, derived_tables
from ..sources.schemas import not_null, retail_schema
from .registry import register

c = F.col


def _work(spark, sf_dir, name):
    return f"{_checkpoint_root(spark)}/aisle-work/{_fingerprint(spark, sf_dir)}/{name}-{uuid.uuid4().hex[:12]}"


def _all(parts):
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


def _union_sql(parts):
    return "\nUNION ALL\n".join(parts)


def _columns(table):
    return retail_schema(table).fieldNames()


def _counts_sql(names):
    return _union_sql(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in names)


def _counts(spark, dfs):
    return _all([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
                 for n, df in dfs.items()])


TEXT_CODEC = "snappy"  # costs next to no time; a file is one input split


@contextmanager
def _staged(spark, path):
    """Text staged under ``path`` inside: it goes when its load has ended, so
    that the disk holds the text of one table, not of all."""
    try:
        yield
    finally:
        delimited.remove_text(spark, path)


def _profile(table, df):
    """One row for a table: rows, values that are not NULL, and characters of
    all values as text, so a lost, moved or recoded value shows."""
    def total(cols):
        whole = F.lit(0).cast("long")
        for x in cols:
            whole = whole + F.coalesce(x, F.lit(0))
        return whole.cast("long")
    return df.agg(F.count(F.lit(1)).alias("row_count"), total([F.count(x) for x in df.columns]).alias("value_count"),
                  total([F.sum(F.length(c(x).cast("string"))) for x in df.columns]).alias("char_count")) \
        .select(F.lit(table).alias("table_name"), "row_count", "value_count", "char_count")


def _profile_sql(table, cols):
    values = " + ".join(f"count({x})" for x in cols)
    chars = " + ".join(f"coalesce(sum(length(CAST({x} AS VARCHAR))), 0)" for x in cols)
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, CAST({values} AS BIGINT) AS value_count, "
            f"CAST({chars} AS BIGINT) AS char_count FROM {table}")


@register("src_delimited", sql=_union_sql(_profile_sql(t, _columns(t)) for t in TABLES))
def src_delimited(spark, sf_dir):
    """Stage all 24 tables as '|' text in latin-1, read them back typed (reject
    limit 1%), and profile what arrived."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in TABLES:
        path = _work(spark, sf_dir, f"text/{n}")
        with _staged(spark, f"{path}/text"):
            delimited.write_delimited(t[n], f"{path}/text", compression=TEXT_CODEC)
            parts.append(_profile(n, delimited.read_delimited(spark, f"{path}/text", retail_schema(n), store=f"{path}/typed")))
    return _all(parts)


def _kept(table):
    """The leading columns up to the last NOT NULL one, two at least."""
    names = _columns(table)
    return names[:max(1, *(names.index(x) for x in not_null(table)), 0) + 1]


@register("src_fill_missing", sql=_union_sql(_profile_sql(t, _kept(t)) for t in TABLES))
def src_fill_missing(spark, sf_dir):
    """Short records are legal: text that ends with the last NOT NULL field
    reads with the full schema, the missing trailing fields as NULL."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in TABLES:
        path = _work(spark, sf_dir, f"short/{n}")
        delimited.write_delimited(t[n].select(*_kept(n)), f"{path}/text")
        parts.append(_profile(n, delimited.read_delimited(spark, f"{path}/text", retail_schema(n), store=f"{path}/typed")))
    return _all(parts)


def _spoiled(table):
    """The first column that may be NULL and is no text."""
    return next((f.name for f in retail_schema(table) if f.nullable and f.dataType.typeName() != "string"), None)


def _keys(table):
    """Sum of the NOT NULL whole-number columns: spreads over the rows."""
    whole = [f.name for f in retail_schema(table).fields if f.name in not_null(table) and f.dataType.typeName() in ("integer", "long")]
    return " + ".join(whole or [_columns(table)[0]])


def _rejects_sql(table):
    col_name = _spoiled(table)
    bad = f"count(CASE WHEN ({_keys(table)}) % 499 = 0 THEN {col_name} END)" if col_name else "CAST(0 AS BIGINT)"
    return f"SELECT '{table}' AS table_name, count(*) - {bad} AS good_rows, {bad} AS rejected_rows FROM {table}"


def _spoil(df, table, hit):
    """``df`` as text in which the rows of ``hit`` have a malformed value."""
    col_name = _spoiled(table)
    if not col_name:
        return df
    text = c(col_name).cast("string")
    return df.withColumn(col_name, F.when(hit, F.concat(F.lit("x"), text)).otherwise(text))


def _both_counts(table, good, rejected):
    both = good.select(F.lit(1).alias("good"), F.lit(0).alias("bad")).unionByName(
        rejected.select(F.lit(0).alias("good"), F.lit(1).alias("bad")))
    return both.agg(F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good_rows"),
                    F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("rejected_rows")) \
        .select(F.lit(table).alias("table_name"), "good_rows", "rejected_rows")


@register("src_reject_limit", sql=_union_sql(map(_rejects_sql, TABLES)))
def src_reject_limit(spark, sf_dir, max_pct=1.0):
    """In each table one row of about 499 gets a malformed value in the staged
    text; they are quarantined, the rest load, and the share stays under the
    limit of 1 % in every input split."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in TABLES:
        path, schema = _work(spark, sf_dir, f"bad/{n}"), retail_schema(n)
        with _staged(spark, f"{path}/text"):
            delimited.write_delimited(_spoil(t[n], n, F.expr(f"({_keys(n)}) % 499 = 0")), f"{path}/text", compression=TEXT_CODEC)
            parts.append(_both_counts(n, *delimited.ingest(delimited.read_raw(spark, f"{path}/text", schema), schema, f"{path}/typed", max_pct)))
    return _all(parts)


def _split_rejects_sql(table):
    bad = f"count(CASE WHEN ({_keys(table)}) % 150 = 0 AND {_spoiled(table)} IS NOT NULL THEN 1 END)"
    return (f"SELECT '{table}' AS table_name, count(*) AS row_count, {bad} AS rejected_rows, 100 * {bad} <= count(*) AS table_within, "
            f"{bad} > 0 AS load_failed FROM {table}")


@register("src_reject_split", sql=_union_sql(map(_split_rejects_sql, FACTS)))
def src_reject_split(spark, sf_dir, max_pct=1.0, min_rows=1):
    """The limit holds in every input split: the malformed rows of a fact
    (one of about 150) are staged in files of their own, so the table keeps
    the limit as a whole and its load fails.  The counts are summed from those
    of the splits that the failed load stored."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in FACTS:
        path, schema = _work(spark, sf_dir, f"split/{n}"), retail_schema(n)
        hit = F.expr(f"({_keys(n)}) % 150 = 0 AND {_spoiled(n)} IS NOT NULL")
        with _staged(spark, f"{path}/text"):
            delimited.write_delimited(t[n].filter(~hit), f"{path}/text/clean", compression=TEXT_CODEC)
            delimited.write_delimited(_spoil(t[n].filter(hit), n, F.lit(True)), f"{path}/text/spoiled", compression=TEXT_CODEC)
            raw = delimited.read_raw(spark, [f"{path}/text/clean", f"{path}/text/spoiled"], schema)
            try:
                delimited.ingest(raw, schema, f"{path}/typed", max_pct, min_rows)
                failed = False
            except delimited.RejectLimitExceeded:
                failed = True
        total = delimited.stored_splits(spark, f"{path}/typed").agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"), F.coalesce(F.sum("reject_count"), F.lit(0)).alias("rejected_rows"))
        parts.append(total.select(F.lit(n).alias("table_name"), "row_count", "rejected_rows",
                                  (100 * c("rejected_rows") <= max_pct * c("row_count")).alias("table_within"), F.lit(failed).alias("load_failed")))
    return _all(parts)


DRIVER = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@register("src_internal", prelude=None, sql=_counts_sql(DRIVER))
def src_internal(spark, sf_dir):
    """Scan stored tables (``load_tables``): row count of each input table."""
    return _counts(spark, load_tables(spark, sf_dir, DRIVER))


def load_tables(spark, sf_dir, names):
    out = {}
    for n in names:
        df = spark.read.parquet(f"{sf_dir}/{n}.parquet")
        df.createOrReplaceTempView(f"src_{n}")
        out[n] = df
    return out


@register("sink_full_load", sql=_counts_sql(TABLES))
def sink_full_load(spark, sf_dir):
    """Create-or-replace all 24 tables in a load folder; counts read back."""
    root = _full_load(spark, sf_dir)
    return _counts(spark, {n: spark.read.parquet(f"{root}/{n}") for n in TABLES})


def _full_load(spark, sf_dir):
    t = derived_tables(spark, sf_dir)
    root = _work(spark, sf_dir, "load")
    for n in TABLES:
        tables.load_table(t[n], f"{root}/{n}", tables.write_options())
    return root


# The registered partition jobs start their ranges this many days after the
# first day of the data, so that there are outliers.
EDGE = 30


def _range_sql(table):
    k = tables.PART_KEY[table]
    return (f"SELECT '{table}' AS table_name, CASE WHEN {k} BETWEEN lo AND hi "
            f"THEN CAST(lo + floor(({k} - lo) / $days) * $days AS INT) ELSE -1 END AS part_start, count(*) AS row_count "
            f"FROM {table}, (SELECT min({k}) + {EDGE} AS lo, max({k}) AS hi FROM {table}) b GROUP BY 1, 2")


@register("sink_range_partition", sql=_union_sql(map(_range_sql, FACTS)))
def sink_range_partition(spark, sf_dir, days=30):
    """The seven facts in range partitions of ``days`` on their date key plus
    the outlier partition; rows per partition read back from the folders."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in FACTS:
        path, key = _work(spark, sf_dir, f"part/{n}"), tables.PART_KEY[n]
        lo, hi = tables.key_range(t[n], key)
        tables.write_range_partitioned(t[n], key, days, path, lo + EDGE, hi)
        parts.append(spark.read.parquet(path).groupBy("part_start").agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(n).alias("table_name"), "part_start", "row_count"))
    return _all(parts)


@register("sink_by_partition", sql="SELECT table_name, part_start, row_count, left_out FROM (\n"
          + _union_sql(f"SELECT *, coalesce(sum(CASE WHEN part_start = -1 THEN row_count END) OVER (), 0)::BIGINT AS left_out "
                       f"FROM ({_range_sql(n)}) x" for n in FACTS) + ") y WHERE part_start <> -1")
def sink_by_partition(spark, sf_dir, days=90):
    """Partition-by-partition load of the seven facts: rows outside every
    range are not loaded, and counted in ``left_out``."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in FACTS:
        path, key = _work(spark, sf_dir, f"bypart/{n}"), tables.PART_KEY[n]
        lo, hi = tables.key_range(t[n], key)
        left = tables.load_partitions(spark, t[n], key, days, path, lo=lo + EDGE, hi=hi)
        parts.append(spark.read.parquet(path).groupBy("part_start").agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(n).alias("table_name"), "part_start", "row_count", F.lit(left).cast("long").alias("left_out")))
    return _all(parts)


@register("sink_format", sql="""SELECT 'none' AS codec, count(*) AS row_count, CAST(sum(ss_net_profit) AS DECIMAL(38,2)) AS profit
FROM store_sales
UNION ALL
SELECT 'snappy', count(*), CAST(sum(ss_net_profit) AS DECIMAL(38,2)) FROM store_sales""")
def sink_format(spark, sf_dir, row_group=8192):
    """Parquet with a small row group, uncompressed and snappy; read back."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for codec in ("none", "snappy"):
        path = _work(spark, sf_dir, f"format/{codec}")
        tables.load_table(t["store_sales"], path, tables.write_options("parquet", row_group, codec))
        parts.append(spark.read.parquet(path).agg(
            F.count(F.lit(1)).alias("row_count"), F.sum("ss_net_profit").cast("decimal(38,2)").alias("profit"))
            .select(F.lit(codec).alias("codec"), "row_count", "profit"))
    return _all(parts)


def _money(table):
    return [f.name for f in retail_schema(table) if f.dataType.typeName() == "decimal"]


MONEY_FACTS = [n for n in FACTS if _money(n)]


@register("sink_money_type", sql=_union_sql(
    f"SELECT '{n}' AS table_name, '{m}' AS column_name, count({m}) AS value_count, CAST(sum({m}) AS DECIMAL(38,2)) AS total FROM {n}"
    for n in MONEY_FACTS for m in _money(n)))
def sink_money_type(spark, sf_dir):
    """The floating-point variant of the facts: every money column is stored
    as a double and keeps its cents (summed exactly, one row per column)."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for n in MONEY_FACTS:
        path = _work(spark, sf_dir, f"money/{n}")
        tables.load_table(tables.with_money(t[n], "double"), path)
        back = spark.read.parquet(path)
        assert all(dict(back.dtypes)[m] == "double" for m in _money(n))
        one = back.agg(*[F.count(m).alias(f"{m}_n") for m in _money(n)],
                       *[F.sum(c(m).cast("decimal(20,2)")).cast("decimal(38,2)").alias(f"{m}_s") for m in _money(n)])
        rows = F.array(*[F.struct(F.lit(n).alias("table_name"), F.lit(m).alias("column_name"), c(f"{m}_n").alias("value_count"),
                                  c(f"{m}_s").alias("total")) for m in _money(n)])
        parts.append(one.select(F.explode(rows).alias("r")).select("r.*"))
    return _all(parts)


@register("sink_distribution", sql=_union_sql(
    f"SELECT '{n}' AS table_name, CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count, CAST(0 AS BIGINT) AS split_keys "
    f"FROM (SELECT count(*) AS n FROM {n} GROUP BY {', '.join(tables.DIST_KEY[n])}) g" for n in FACTS))
def sink_distribution(spark, sf_dir, n=16):
    """The seven facts hash-distributed by their declared keys (a sale and its
    return share them): rows, keys, and keys found in more than one part."""
    t = derived_tables(spark, sf_dir)
    parts = []
    for name in FACTS:
        keys = tables.DIST_KEY[name]
        placed = tables.distribute(t[name].select(*keys), keys, n).withColumn("part", F.spark_partition_id())
        # a part has as many keys as the fact has rows for it: they are
        # counted in slices of the parts, whose number grows with the input
        placed = tables.distribute(placed, keys, tables.shuffle_partitions(spark))
        per_key = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi"))
        parts.append(per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("row_count"), F.count(F.lit(1)).alias("key_count"),
                                 F.count(F.when(c("lo") != c("hi"), 1)).alias("split_keys"))
                     .select(F.lit(name).alias("table_name"), "row_count", "key_count", "split_keys"))
    return _all(parts)


@register("job_row_reconcile", sql=_union_sql(
    f"SELECT '{n}' AS table_name, count(*) AS expected, count(*) AS actual, CAST(0 AS BIGINT) AS rejected, true AS ok FROM {n}"
    for n in FACTS))
def job_row_reconcile(spark, sf_dir):
    """Expected (source) against actual (stored) rows of the seven facts."""
    t = derived_tables(spark, sf_dir)
    root = _work(spark, sf_dir, "reconcile")
    pairs = {}
    for n in FACTS:
        tables.load_table(t[n], f"{root}/{n}")
        pairs[n] = (t[n], spark.read.parquet(f"{root}/{n}"))
    return jobs.reconcile(spark, pairs)


def _stats_sql(table):
    return _union_sql(
        f"SELECT '{table}' AS table_name, '{x}' AS column_name, count(*) AS row_count, count(*) - count({x}) AS null_count, "
        f"true AS ndv_close, CAST(min({x}) AS VARCHAR) AS min_value, CAST(max({x}) AS VARCHAR) AS max_value FROM {table}"
        for x in _columns(table))


@register("job_table_stats", sql=_union_sql(map(_stats_sql, TABLES)))
def job_table_stats(spark, sf_dir):
    """Column statistics of all 24 tables, one aggregation per table, through
    the shipped path (HyperLogLog estimates).  ``ndv_close``: the estimate
    lies between one and the number of values, with a tenth to spare."""
    t = derived_tables(spark, sf_dir)
    values = c("row_count") - c("null_count")
    close = (c("ndv") >= F.least(values, F.lit(1))) & (c("ndv") <= values * 1.1 + 1)
    return _all([jobs.table_stats(t[n]).select(F.lit(n).alias("table_name"), "column_name", "row_count", "null_count",
                                               close.alias("ndv_close"), "min_value", "max_value") for n in TABLES])


@register("job_storage_report", sql=_union_sql(f"SELECT '{n}' AS table_name, true AS has_files, true AS has_bytes" for n in TABLES))
def job_storage_report(spark, sf_dir):
    """Stored tables of a full load.  Sizes depend on the writer, so the
    registered form says whether each table has files and bytes."""
    report = jobs.storage_report(spark, _full_load(spark, sf_dir))
    return report.select("table_name", (c("files") > 0).alias("has_files"), (c("bytes") > 0).alias("has_bytes"))


@register("job_generate", prelude=None, sql=_union_sql(
    f"SELECT '{n}' AS table_name, {'' if n in jobs.DIMENSIONS else '$copies * '}count(*) AS row_count FROM {n}" for n in DRIVER))
def job_generate(spark, sf_dir, copies=2):
    """Scale-out generation: ``copies`` key-shifted copies of the order-entry
    tables and their dimensions, written in parallel, counts read back."""
    root = _work(spark, sf_dir, f"generate_{copies}")
    out = jobs.generate(spark, sf_dir, copies)
    for n, df in out.items():
        df.write.mode("overwrite").parquet(f"{root}/{n}.parquet")
    return _counts(spark, {n: spark.read.parquet(f"{root}/{n}.parquet") for n in out})
