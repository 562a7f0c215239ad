"""Similarity join of documents on the Jaccard similarity of their runs of
five words: a chosen-path join.

1. Each document becomes its set of shingle hashes; kept are a digest of the
   set and a MinHash sketch, whose coordinates are tokens sampled from the
   set.  Documents with equal sets form a class, and one goes on for all.
2. A run splits all sets on one sampled token, so two sets meet in a bucket
   with the probability of their similarity.  A bucket above ``LEAF`` sets is
   split again on further sampled tokens, unless the split keeps most of it
   together; small and dense buckets, and those at the last depth, are
   compared by brute force.  Runs are repeated until a pair at the threshold
   is met with the target recall.  Buckets of any size are compared: large
   ones in pairs of blocks, each pair a task of its own.
3. Brute force in a bucket compares sketches, and only links that span the
   bucket leave it, not all its pairs.  Connected components of these give
   clusters, and in each cluster all pairs are verified exactly on the sets,
   again in pairs of blocks.  So a link is counted once, however many
   buckets held it, and a cluster of m documents gives m rows and not m * m.

Edge cases: a null text counts as empty; texts without words form one class
without links to others; rows without an id are left out; rows that repeat an
id count as one document (of the least digest); an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_key, key_runs, local_roots, stored
from .components import components
from .shingles import mix64, shingles

SKETCH = 64          # coordinates of a sketch
LEAF = 2048          # sets up to which a bucket is not split
DEPTH = 3            # splits of a run at most
CHILDREN = 3         # tokens on which a large bucket is split
BLOCK = 1024         # sets in a block of a bucket
CLUSTER_BLOCK = 1 << 20   # shingles in a block of a cluster
CLUSTER_SETS = 4096  # sets in a block of a cluster
STRIPE = 1 << 20     # pairs of sets that are judged at a time
SLACK = 0.25         # sketches this far below the threshold are still verified: five standard errors

_A = mix64(np.arange(1, SKETCH + 1, dtype=np.uint64)) | np.uint64(1)
_B = mix64(np.arange(1001, SKETCH + 1001, dtype=np.uint64))


def digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def sketch(hashes: np.ndarray) -> bytes:
    """The least hash under each of the fixed hash functions, 32 bits each."""
    if not len(hashes):
        return b""
    least = np.full(SKETCH, np.iinfo(np.uint64).max)
    for lo in range(0, len(hashes), 1024):
        np.minimum(least, (_A[:, None] * hashes[lo:lo + 1024] + _B[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        sets = (shingles(texts[i].as_py()) for i in range(batch.num_rows))
        rows = [(len(s), digest(s), sketch(s)) for s in sets]
        if rows:
            n, d, k = zip(*rows)
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(d, pa.binary()), pa.array(k, pa.binary())],
                                             names=["doc_id", "n", "digest", "sketch"])


def _token(sketch_column: Column, place) -> Column:
    """A coordinate of a sketch."""
    return F.substring(sketch_column, (place * 4 + 1), F.lit(4))


def _counted(rows: DataFrame, name: str) -> DataFrame:
    """Adds ``m``, the sets in the bucket; buckets of one are left out."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    return stored(rows.join(sizes, "key"), name)


def _blocks(df: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Deal the rows of each ``key`` into blocks; each row goes to every pair
    of blocks that holds its own.  Adds ``pair`` (the group) and ``side``: 0
    and 1 for the two blocks, -1 where both are the same."""
    mine = F.pmod(F.xxhash64("rep", key), F.col("_n"))
    lo, hi = F.least("_mine", "_other"), F.greatest("_mine", "_other")
    return (df.withColumn("_n", blocks.cast("long")).withColumn("_mine", mine)
            .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
            .withColumn("pair", F.xxhash64(key, lo, hi))
            .withColumn("side", F.when(lo == hi, -1).otherwise((F.col("_mine") == hi).cast("int")))
            .drop("_n", "_mine", "_other"))


def _buckets(reps: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(key, rep, m): the buckets that are compared by brute force."""
    meet = threshold * (1 - (1 - threshold) ** CHILDREN) ** (DEPTH - 1)
    runs = min(SKETCH, math.ceil(math.log(1 - recall) / math.log(1 - meet)))
    first = F.array(*(F.xxhash64(F.lit(r), _token(F.col("sketch"), F.lit(r))) for r in range(runs)))
    rows = _counted(reps.select("rep", F.explode(first).alias("key")), "buckets")
    done = [rows.where(F.col("m") <= LEAF)]
    large = rows.where(F.col("m") > LEAF)
    for _ in range(DEPTH - 1):
        if large.isEmpty():
            break
        children = F.array(*(F.xxhash64("key", F.lit(c), _token(F.col("sketch"), F.pmod(F.xxhash64("key", F.lit(c)), F.lit(SKETCH)).cast("int")))
                             for c in range(CHILDREN)))
        split = (large.join(reps.select("rep", "sketch"), "rep")
                 .select("rep", F.col("m").alias("parent"), F.explode(children).alias("key")))
        split = _counted(split, "buckets")
        final = (F.col("m") <= LEAF) | (F.col("m") * 2 > F.col("parent"))  # dense: a split keeps it together
        done.append(split.where(final).drop("parent"))
        large = split.where(~final).drop("parent")
    out = large
    for part in done:
        out = out.unionByName(part)
    return out


def _spanning(threshold: float):
    """Links (a, b) that span the sets of a bucket whose sketches are near."""
    least = math.ceil((threshold - SLACK) * SKETCH)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_runs(batches, "pair"):
            reps = group.column("rep").to_numpy()
            side = group.column("side").to_numpy()
            s = np.frombuffer(b"".join(group.column("sketch").to_pylist()), "<u4").reshape(-1, SKETCH)
            left, right = [], []
            ours = np.flatnonzero(side < 1)
            others = ours if side[0] < 0 else np.flatnonzero(side == 1)
            for lo in range(0, len(ours), 64):
                part = ours[lo:lo + 64]
                alike = (s[part][:, None, :] == s[others][None, :, :]).sum(axis=2, dtype=np.int16)
                i, j = np.nonzero(alike >= least)
                left.append(part[i])
                right.append(others[j])
            if not left:
                continue
            root = local_roots(len(reps), np.concatenate(left), np.concatenate(right))
            moved = np.flatnonzero(root != np.arange(len(reps)))
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(reps[moved]), pa.array(reps[root[moved]])], names=["a", "b"])
    return near


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each document; another text under the same id falls out."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 128):
            rows = batch.slice(lo, 128)
            sets = [shingles(t.as_py()) for t in rows.column("text")]
            kept = [i for i, (s, d) in enumerate(zip(sets, rows.column("digest"))) if digest(s) == d.as_py()]
            rows = rows.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in ("rep", "mult", "cluster", "blocks")),
                 pa.array([sets[i].tobytes() for i in kept], pa.binary())],
                names=["rep", "mult", "cluster", "blocks", "hashes"])


def shared(ours: list[np.ndarray], others: list[np.ndarray] | None) -> np.ndarray:
    """The sizes of the intersections of each of ``ours`` with each of
    ``others`` (None: of ``ours``)."""
    sets = ours if others is None else ours + others
    tokens, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    often = count[token] > 1  # a token of one set alone is in no intersection
    place = np.cumsum(count > 1) - 1
    row, token = row[often], place[token[often]]
    order = np.argsort(token, kind="stable")
    row, token = row[order], token[order]
    total = np.zeros((len(ours), len(sets) - len(ours) if others is not None else len(ours)), np.float32)
    width = min(4096, max(256, (1 << 24) // len(sets)))
    for lo in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        a, b = np.searchsorted(token, [lo, lo + width])
        used = np.zeros((len(sets), min(width, int(token[-1]) + 1 - lo)), np.float32)
        used[row[a:b], token[a:b] - lo] = 1
        total += used[:len(ours)] @ (used if others is None else used[len(ours):]).T
    return total


def _verified(threshold: float):
    """For each set of a group with links: their number and the first set
    that they reach inside the group."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_runs(batches, "pair"):
            # a repeated row of the input brings its set again
            group = group.take(pa.array(np.sort(np.unique(group.column("rep").to_numpy(), return_index=True)[1])))
            reps = group.column("rep").to_numpy()
            mult = group.column("mult").to_numpy()
            side = group.column("side").to_numpy()
            sets = [np.frombuffer(h.as_py(), np.uint64) for h in group.column("hashes")]
            size = np.array([len(s) for s in sets], np.float64)
            same = side[0] < 0
            ours = np.flatnonzero(side < 1)
            others = ours if same else np.flatnonzero(side == 1)
            if not len(others) or len(reps) < 2:
                continue
            both = shared([sets[i] for i in ours], None if same else [sets[i] for i in others])
            links, root = np.zeros(len(reps), np.int64), np.arange(len(reps))
            step = max(1, STRIPE // len(others))
            for lo in range(0, len(ours), step):
                part, common = ours[lo:lo + step], both[lo:lo + step]
                linked = common / (size[part][:, None] + size[others][None, :] - common) >= threshold
                if same:
                    linked[np.arange(len(part)), lo + np.arange(len(part))] = False
                links[part] += (linked * mult[others]).sum(axis=1)
                if not same:
                    links[others] += (linked * mult[part][:, None]).sum(axis=0)
                i, j = np.nonzero(linked)
                i, j = root[part[i]], root[others[j]]
                root = local_roots(len(reps), i[i != j], j[i != j])[root]
            used = np.flatnonzero(links)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(reps[used]), pa.array(links[used]), pa.array(reps[root[used]])],
                                                 names=["rep", "links", "root"])
    return verify


def similarity_join(docs: DataFrame, threshold: float = 0.8, recall: float = 1 - 1e-6) -> DataFrame:
    """doc_id, class_id (the least id that links reach), n_links (other
    documents whose similarity is ``threshold`` or more) from ``docs``
    (doc_id, text; other columns are left out)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    one = Window.partitionBy("doc_id").orderBy("digest")
    signed = docs.mapInArrow(_signatures, "doc_id long, n long, digest binary, sketch binary")
    signed = stored(signed.withColumn("_row", F.row_number().over(one)).where("_row = 1").drop("_row"), "signatures")
    classes = stored(signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("mult")), "classes")
    reps = stored(classes.join(signed.withColumnRenamed("doc_id", "rep"), ["rep", "digest"]).where("n > 0")
                  .select("rep", "mult", "n", "digest", "sketch"), "reps")
    # the candidates
    buckets = _blocks(_buckets(reps, threshold, recall), "key", F.ceil(F.col("m") / BLOCK)).drop("key", "m")
    meeting = by_key(buckets.join(reps.select("rep", "sketch"), "rep").select("pair", "rep", "side", "sketch"), "pair")
    clusters = components(meeting.mapInArrow(_spanning(threshold), "a long, b long"))
    clusters = clusters.select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    # the exact links
    members = clusters.join(reps.select("rep", "mult", "n", "digest"), "rep")
    sizes = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.sum("n") / CLUSTER_BLOCK), F.ceil(F.count("*") / CLUSTER_SETS)).alias("blocks"))
    members = stored(members.join(sizes, "cluster").select("rep", "mult", "digest", "cluster", "blocks"), "members")
    # a shuffle of the texts at every size, also where the members are few
    sets = docs.join(members.hint("merge"), docs.doc_id == members.rep).select("text", "rep", "mult", "digest", "cluster", "blocks") \
        .mapInArrow(_sets, "rep long, mult long, cluster long, blocks long, hashes binary")
    groups = by_key(_blocks(sets, "cluster", F.col("blocks")).select("pair", "rep", "mult", "side", "hashes"), "pair")
    found = stored(groups.mapInArrow(_verified(threshold), "rep long, links long, root long"), "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_rep = (classes.join(links, "rep", "left").join(reached.withColumnRenamed("node", "rep"), "rep", "left")
              .select("digest", F.coalesce("component", "rep").alias("class_id"),
                      (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return signed.select("doc_id", "digest").join(of_rep, "digest").select("doc_id", "class_id", "n_links")
