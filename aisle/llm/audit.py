"""Interaction audit of filters: what each removes in every order.

Rows are dealt by ranges of (part, id) and cut into segments of at most
``SEGMENT`` rows of one part.  For each segment a sorted posting list is kept
per filter (the rows that fail it) and per mark (rows of interest, such as
good ones).  An entry is the row's number in id order within its segment, as
in an inverted index, so repeated and null ids count row by row; the
segment's ids are kept beside the lists.

For a filter f and a set S of filters that ran before it, f removes the
difference of f's list and the union of the lists of S.  Unions and
differences are galloping k-way merges inside a segment (``union``,
``difference``): a block of the shorter list finds its stretch of the longer
one by steps that double from where the last block ended.  Their sizes add up
over segments, one row per (part, f, S), and every order of the filters reads
its steps off those sums.

Edge cases: a null flag does not fail and a null mark does not count; a null
part is the empty text; null ids come first; an empty table has no parts.  A
part of any size, however hot, is split over segments and tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SEGMENT = 1 << 16
BLOCK = 1 << 10


def _gallop(longer: np.ndarray, lo: int, key: int) -> int:
    """The first place from ``lo`` on whose entry is not below ``key``."""
    step, hi = 1, lo
    while hi < len(longer) and longer[hi] < key:
        lo, hi, step = hi + 1, hi + step, step * 2
    return lo + int(np.searchsorted(longer[lo:hi], key))


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which entries of the sorted list ``a`` the sorted list ``b`` holds."""
    if len(a) > len(b):  # walk the shorter list
        found = np.zeros(len(a), bool)
        found[np.searchsorted(a, b[shared(b, a)])] = True
        return found
    found, lo = np.zeros(len(a), bool), 0
    for at in range(0, len(a), BLOCK):
        block = a[at:at + BLOCK]
        lo = _gallop(b, lo, block[0])
        hi = _gallop(b, lo, block[-1] + 1)
        if hi > lo:
            window = b[lo:hi]
            place = np.minimum(np.searchsorted(window, block), len(window) - 1)
            found[at:at + BLOCK] = window[place] == block
        lo = hi
    return found


def difference(a: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """Entries of ``a`` that no other list holds."""
    for b in sorted(others, key=len, reverse=True):
        a = a[~shared(a, b)] if len(a) and len(b) else a
    return a


def union(*lists: np.ndarray) -> np.ndarray:
    """The sorted union: what each list adds goes into its place among the
    entries so far, stretch by stretch."""
    out = np.zeros(0, np.int32)
    for b in sorted(lists, key=len, reverse=True):
        new = difference(b, out)
        out = np.insert(out, np.searchsorted(out, new), new) if len(new) else out
    return out


def posting_lists(rows: DataFrame, doc_id: str, part: str, fails: dict[str, str], marks: dict[str, str]) -> DataFrame:
    """part, first_id, last_id, n_rows, ids and one list per filter and mark,
    by segments of a part.  ``fails`` and ``marks`` name the boolean column
    of each."""
    names = [*fails, *marks]
    schema = ("part string, first_id long, last_id long, n_rows long, ids array<long>, "
              + ", ".join(f"`{n}` array<int>" for n in names))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            flags = t.column("flags").to_numpy()
            ids = t.column("id").to_pylist()
            return pa.RecordBatch.from_arrays(
                [pa.array([t.column("part")[0].as_py()], pa.string()), pa.array([ids[0]], pa.int64()), pa.array([ids[-1]], pa.int64()),
                 pa.array([len(ids)], pa.int64()), pa.array([ids], pa.list_(pa.int64()))]
                + [pa.array([np.flatnonzero(flags >> i & 1).astype(np.int32)], pa.list_(pa.int32())) for i in range(len(names))],
                names=["part", "first_id", "last_id", "n_rows", "ids", *names])
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                p = batch.column(0)
                if held and held[0].column(0)[0] != p[at]:
                    yield flush()
                room = SEGMENT - sum(b.num_rows for b in held)
                same = np.flatnonzero(p.slice(at, room).to_numpy(zero_copy_only=False) != p[at].as_py())
                n = int(same[0]) if len(same) else min(room, batch.num_rows - at)
                held.append(batch.slice(at, n))
                at += n
                if n == room:
                    yield flush()
        if held:
            yield flush()

    bits = [F.when(F.col(c), 1 << i).otherwise(0) for i, c in enumerate([*fails.values(), *marks.values()])]
    flat = rows.select(F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(doc_id).cast("long").alias("id"),
                       reduce(lambda a, b: a + b, bits, F.lit(0)).cast("int").alias("flags"))
    # ranges end inside a part, and inside a repeated id where its flags differ
    dealt = flat.repartitionByRange("part", "id", "flags").sortWithinPartitions("part", "id", "flags")
    return dealt.mapInArrow(segments, schema)


def merges(postings: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """part, filter (its place), earlier (bit set of the filters that ran
    before), n and one count per mark: the rows that the filter removes.  A
    row with the filter -1 has the part's number of rows as n."""
    k = len(filters)
    schema = "part string, filter int, earlier int, n long" + "".join(f", `{m}` long" for m in marks)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                lists = [batch.column(3 + i)[r].values.to_numpy(zero_copy_only=False) for i in range(k + len(marks))]
                unions = [np.zeros(0, np.int32)] * (1 << k)
                out = []
                for s in range(1 << k):
                    if s:
                        low = (s & -s).bit_length() - 1
                        unions[s] = union(unions[s & (s - 1)], lists[low])
                    for f in range(k):
                        if not s >> f & 1:
                            removed = difference(lists[f], unions[s])
                            out.append((f, s, len(removed), *(int(shared(removed, m).sum()) for m in lists[k:])))
                out.append((-1, 0, batch.column(1)[r].as_py(), *[0] * len(marks)))
                part = batch.column(0)[r].as_py()
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(["part", "filter", "earlier", "n", *marks], (part, *row))) for row in out],
                    schema=pa.schema([("part", pa.string()), ("filter", pa.int32()), ("earlier", pa.int32()), ("n", pa.int64())]
                                     + [(m, pa.int64()) for m in marks]))
    # the ids stay behind; a null list cannot be, so its values are the whole row
    rows = postings.select("part", "n_rows", "first_id", *[F.col(f"`{c}`") for c in [*filters, *marks]])
    return (rows.mapInArrow(sizes, schema).groupBy("part", "filter", "earlier")
            .agg(F.sum("n").alias("n"), *[F.sum(f"`{m}`").alias(m) for m in marks]))


def interactions(rows: DataFrame, doc_id: str, part: str, fails: dict[str, str], marks: dict[str, str]) -> DataFrame:
    """One row per part, order of the filters (their names joined) and step:
    kept, removed, redundant, unique_fails, one lost_<mark> per mark, shapley.

    ``rows`` holds one row per document with boolean columns; filters have
    names of one letter each.  All orders are listed, so filters are few."""
    filters, k = [*fails], len(fails)
    spark = rows.sparkSession
    postings = stored(posting_lists(rows, doc_id, part, fails, marks), "postings")
    sums = stored(merges(postings, filters, [*marks]), "interactions")
    everything = sums.where("filter = -1").select(F.col("part").alias("p"), F.col("n").alias("n_rows"))
    per_part = (sums.where("filter >= 0").groupBy("part", "filter").agg(
        F.max(F.when(F.col("earlier") == 0, F.col("n"))).alias("fails"),
        F.max(F.when(F.col("earlier") == F.lit((1 << k) - 1) - F.call_function("shiftleft", F.lit(1), F.col("filter")), F.col("n"))).alias("unique_fails"),
        # every order: a set of s filters in front stands in s! (k - 1 - s)! of them
        F.sum(F.col("n") * _by_size(F.bit_count("earlier"), k)).alias("shapley")))
    steps = spark.createDataFrame(
        [("".join(filters[i] for i in order), at + 1, f, sum(1 << i for i in order[:at]))
         for order in permutations(range(k)) for at, f in enumerate(order)], "filter_order string, step int, filter int, earlier int")
    # k! * k fixed rows; two counts per part and filter
    found = (sums.join(F.broadcast(steps), ["filter", "earlier"]).join(per_part, ["part", "filter"])
             .join(everything, F.col("part") == F.col("p")))
    gone = F.sum("n").over(_so_far())
    return found.select("part", "filter_order", "step", (F.col("n_rows") - gone).alias("kept"), F.col("n").alias("removed"),
                        (F.col("fails") - F.col("n")).alias("redundant"), "unique_fails",
                        *[F.col(f"`{m}`").alias(f"lost_{m}") for m in marks], "shapley")


def _by_size(size: Column, k: int) -> Column:
    out = F.lit(0)
    for s in range(k):
        out = F.when(size == s, factorial(s) * factorial(k - 1 - s)).otherwise(out)
    return out.cast("long")


def _so_far():
    return Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)


def first_of_text(docs: DataFrame, doc_id: str, digest: str) -> DataFrame:
    """Adds ``later``: a smaller id has an equal digest.

    Per digest the least id is found (combined before the shuffle); a row is
    no copy where it holds that id, so rows meet the least ids by their own
    id and a text with any number of copies stays spread.  Null ids are
    smaller than nothing and larger than nothing."""
    first = (docs.where(F.col(doc_id).isNotNull()).groupBy(F.col(digest).alias("_digest"))
             .agg(F.min(doc_id).alias("_first")).withColumn("_is_first", F.lit(True)))
    joined = docs.join(first, (F.col(doc_id) == F.col("_first")) & (F.col(digest) == F.col("_digest")), "left")
    return joined.withColumn("later", F.col(doc_id).isNotNull() & F.col("_is_first").isNull()).drop("_digest", "_first", "_is_first")
