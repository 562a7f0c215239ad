"""Mixing sources to target weights.

Targets: sources, in code point order with null last, get the cycled weights;
the mix shares ``share`` times the words of all documents by weight, and no
source gets more than ``most`` times its own words: the excess is shared
again among the others until none is above.

Selection (Efraimidis-Spirakis): a document of quality weight w gets the key
E / w with E exponential, drawn from a hash of its id, and a source takes its
documents in the order of their keys.  A target is first met by complete
epochs; the rest is a prefix of that order, found by prefix sums: sums per
bucket of keys first, then rows inside buckets, so a hot source is spread
over many tasks.  The one document in which the target falls is taken in
part, so each source meets its target to the word.

Edge cases: a null text has no words and is never taken; a null or repeated
id is drawn like any other, rows that agree in id and size being taken in any
order; an empty table gives an empty mix; a source without words has the
target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 256


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target from (source, size).

    The level of sharing (words per weight) rises until it stands: a source
    is either at its cap or gets level times weight.  Only the level and two
    sums pass the driver; a round fixes at least one more source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the order of the sources: one row per source
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*map(F.lit, weights))
    ranked = stored(totals.withColumn("place", (F.row_number().over(order) - 1).cast("int"))
                    .withColumn("weight", F.element_at(cycle, F.col("place") % len(weights) + 1).cast("double"))
                    .withColumn("cap", F.col("source_size") * F.lit(float(most))), "sources")
    whole = ranked.agg((F.sum("source_size") * F.lit(float(share))).alias("mix")).first()["mix"] or 0.0
    level = 0.0
    while True:
        free = F.col("cap") > F.col("weight") * F.lit(level)
        capped, open_weight = ranked.agg(F.sum(F.when(~free, F.col("cap")).otherwise(0.0)),
                                         F.sum(F.when(free, F.col("weight")).otherwise(0.0))).first()
        if not open_weight:
            break
        higher = (whole - capped) / open_weight
        if higher <= level:
            break
        level = higher
    return ranked.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1) from a hash of the id: 52 bits of its MD5."""
    text = F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / F.lit(float(1 << 52))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
        seed: str = "mix") -> DataFrame:
    """doc_id, source, size, source_size, target, epochs, taken from ``docs``
    (doc_id, source, size, quality: the sampling weight, null counts as 1 and
    nothing below 0.01 is used).

    ``taken`` counts words with repeats: ``epochs`` times the size, plus the
    part of the document that the fractional epoch takes."""
    w = F.greatest(F.coalesce(F.col("quality").cast("double"), F.lit(1.0)), F.lit(0.01))
    u = uniform(F.col("doc_id"), seed)
    # u ** (1 / w) falls as the key -ln(u) / w rises; it also spreads over (0, 1)
    # for weights near 1, so equal slices of it are buckets of the order
    rows = stored(docs.select("doc_id", "source", F.col("size").cast("long").alias("size"),
                              (-F.log(u) / w).alias("key"), F.pow(u, 1 / w).alias("spread"))
                  .withColumn("bucket", F.floor((1 - F.col("spread")) * BUCKETS).cast("int")).drop("spread"), "sizes")
    targets = source_targets(rows, weights, share, most)
    plan = targets.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                              .otherwise(0).cast("long")) \
        .withColumn("rest", F.round(F.col("target")).cast("long") - F.col("epochs") * F.col("source_size"))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    below = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("before", F.coalesce(F.sum("words").over(below), F.lit(0))) \
        .join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "words")
    b = starts.select(F.col("source").alias("s"), F.col("bucket").alias("k"), "before", "source_size", "target", "epochs", "rest")
    placed = rows.join(b, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k")))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - ahead))
    return placed.withColumn("part", part).select(
        "doc_id", "source", "size", "source_size", "target", "epochs",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))
