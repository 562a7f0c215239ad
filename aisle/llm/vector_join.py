"""Cosine join of vectors: a subspace pigeonhole join.

For unit vectors, a cosine of c or more is a squared distance of 2 - 2c or
less.  The vectors are rotated and cut into blocks of a few dimensions; the
squared distance is the sum over the blocks, so in one block at least it is
within the block's proportional share.  Each block is range-joined under its
share: a k-d tree, whose cuts are fitted on a bounded sample, deals the block
into cells; a vector goes to its own cell and to each cell that the ball of
its range touches.  In a cell the pairs within range are the candidates, and
each is verified at once by its cosine in double precision.  A pair is
counted in the first block in which it is in range, and there in the cell of
its larger id (of its smaller id if both share the cell), so every link is
counted once without a list of pairs: only counts and links that span a cell
leave it.  Cells of any size are compared: large ones in pairs of blocks, each
pair a task of its own that holds two blocks at most and never its pairs.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link; equal
vectors are compared as one; a null id is left out; rows that repeat an id
count as one vector (the least digest); an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import by_key, key_runs, local_roots, stored
from .components import components

BLOCKS = 8
CELL = 16_384        # vectors of a cell at which the tree stops
SAMPLE = 20_000      # vectors on which the cuts are fitted, or
PER_CELL = 64        # this many for each cell of the tree, if that is more
PART = 16_384        # vectors in a block of a cell; twice as many of those from other cells
VALUES = 1 << 21     # components in a block of a cell
STRIPE = 1 << 21     # distances that are held at a time
ROUNDING = 1e-5      # of distances in single precision


def _read(kind: str):
    """vec_id, dim, digest and the components as bytes of ``kind``; dim 0
    where the vector links with nothing."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for v in batch.column(1):
                x = v.as_py()
                x = np.array(x, kind) + 0.0 if x and None not in x else np.zeros(0)  # + 0.0: no negative zero
                if not (len(x) and np.isfinite(x).all() and x.any()):
                    x = np.zeros(0)
                rows.append((len(x), hashlib.blake2b(x.tobytes(), digest_size=16).digest(), x.tobytes()))
            if rows:
                n, d, x = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int32()), pa.array(d, pa.binary()), pa.array(x, pa.binary())],
                    names=["vec_id", "dim", "digest", "vector"])
    return read


def tree_depth(count: int) -> int:
    """Levels of cuts at which a cell has ``CELL`` of ``count`` vectors."""
    return max(0, math.ceil(math.log2(max(count, 1) / CELL)))


class Space:
    """A rotation, its blocks and a tree of cuts for each."""

    def __init__(self, dim: int, kind: str, cosine: float, count: int, sample: list[bytes]):
        self.dim, self.kind, self.cosine = dim, kind, cosine
        rng = np.random.default_rng(dim)
        self.rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.blocks = np.array_split(np.arange(dim), min(BLOCKS, dim))
        self.budget = np.array([(2 - 2 * cosine) * len(b) / dim + 1e-9 for b in self.blocks])
        self.part = max(1, min(PART, VALUES // dim))
        self.depth = min(tree_depth(count), int(math.log2(max(len(sample), PER_CELL) / PER_CELL)))
        rotated = np.concatenate([np.zeros((0, dim), np.float32), *(
            (self.unit(self.vectors(sample[lo:lo + 4096])) @ self.rotation).astype(np.float32) for lo in range(0, len(sample), 4096))])
        self.trees = [self._tree(rotated[:, b]) for b in self.blocks]

    def vectors(self, stored: list[bytes]) -> np.ndarray:
        """The vectors in double precision."""
        return np.frombuffer(b"".join(stored), self.kind).reshape(-1, self.dim).astype(np.float64)

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def _tree(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The axes and the cuts of the inner nodes, in heap order."""
        nodes, held = [], [points]
        for _ in range(self.depth):
            below = []
            for p in held:
                axis = int(p.std(axis=0).argmax()) if len(p) else 0
                cut = float(np.median(p[:, axis])) if len(p) else 0.0
                nodes.append((axis, cut))
                below += [p[p[:, axis] <= cut], p[p[:, axis] > cut]]
            held = below
        return np.array([n[0] for n in nodes], np.int64), np.array([n[1] for n in nodes], np.float64)

    def cells(self, block: int, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, whether it is the row's own cell) of every cell that
        the range of a row touches."""
        row, node = np.arange(len(y)), np.zeros(len(y), np.int64)
        gap, home = np.zeros(y.shape), np.ones(len(y), bool)
        for level in range(self.depth):
            base = (1 << level) - 1
            axis, cut = (of_tree[base + node] for of_tree in self.trees[block])
            at = y[row, axis]
            far_gap = gap.copy()
            # the box on the other side of the cut is at least this far away
            far_gap[np.arange(len(row)), axis] = np.maximum(gap[np.arange(len(row)), axis], np.abs(at - cut))
            right = at > cut
            touch = (far_gap ** 2).sum(axis=1) <= self.budget[block] + ROUNDING
            row = np.concatenate([row, row[touch]])
            node = np.concatenate([2 * node + right, 2 * node[touch] + ~right[touch]])
            gap = np.concatenate([gap, far_gap[touch]])
            home = np.concatenate([home, np.zeros(int(touch.sum()), bool)])
        return row, node, home


def _deal(space: Space):
    """Every vector to the cells of every block that its range touches."""
    few = max(1, (1 << 20) >> space.depth)  # rows at a time, so that their cells stay few

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(lo, few) for b in batches for lo in range(0, b.num_rows, few)):
            y = space.unit(space.vectors(batch.column("vector").to_pylist())) @ space.rotation
            for k, dims in enumerate(space.blocks):
                every = space.cells(k, y[:, dims])
                for lo in range(0, len(every[0]), space.part):
                    row, cell, home = (c[lo:lo + space.part] for c in every)
                    taken = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), k, np.int32)), pa.array(cell), pa.array(home),
                         *(taken.column(c) for c in ("rep", "mult", "vector"))],
                        names=["block", "cell", "home", "rep", "mult", "vector"])
    return deal


def _clusters(points: np.ndarray, rows: np.ndarray, size: int = 256) -> list[np.ndarray]:
    """``rows`` in groups of neighbours: halved along the widest axis until
    they are small."""
    out, open_ = [], [rows]
    while open_:
        rows = open_.pop()
        if len(rows) <= size:
            if len(rows):
                out.append(rows)
            continue
        p = points[rows]
        order = np.argpartition(p[:, int(np.ptp(p, axis=0).argmax())], len(rows) // 2)
        open_ += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


def _compare(space: Space):
    """Links of the vectors of a block of a cell (side 0; -1 if also among
    themselves) with those of another block (1) or from other cells (2)."""
    stretch = max(1, 2 * VALUES // space.dim)  # pairs that are verified at a time

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in key_runs(batches, "pair"):
            side = group.column("side").to_numpy()
            ours, others = np.flatnonzero(side < 1), np.flatnonzero((side > 0) | (side < 0))
            if not len(ours) or not len(others):
                continue
            reps, mult = group.column("rep").to_numpy(), group.column("mult").to_numpy()
            block = int(group.column("block")[0].as_py())
            unit = space.unit(space.vectors(group.column("vector").to_pylist()))
            y = unit @ space.rotation
            z = y[:, space.blocks[block]].astype(np.float32)
            square = (z ** 2).sum(axis=1, keepdims=True)
            one = np.ones_like(square)
            # the product of these two is the squared distance
            from_, to = np.hstack([z, square, one]), np.hstack([-2 * z, one, square])
            limit = np.float32(space.budget[block] + ROUNDING)
            links, root = np.zeros(len(reps), np.int64), np.arange(len(reps))
            for part in _clusters(z, ours):
                # only what lies within range of the box of these vectors
                gap = np.maximum(z[part].min(axis=0) - z[others], z[others] - z[part].max(axis=0))
                close = others[(np.maximum(gap, 0) ** 2).sum(axis=1) <= limit]
                step = max(1, STRIPE // max(1, len(close)))
                for lo in range(0, len(part), step):
                    i, j = np.nonzero(from_[part[lo:lo + step]] @ to[close].T <= limit)
                    i, j = part[lo + i], close[j]
                    # each pair in one place: see the module's text
                    once = np.where(side[j] < 0, reps[i] < reps[j], (side[j] == 1) | (reps[j] < reps[i]))
                    i, j = i[once], j[once]
                    for at in range(0, len(i), stretch):
                        a, b = i[at:at + stretch], j[at:at + stretch]
                        apart = (y[a] - y[b]) ** 2
                        within = np.stack([apart[:, d].sum(axis=1) for d in space.blocks], axis=1) <= space.budget
                        linked = (within.argmax(axis=1) == block) & within[:, block] & (np.einsum("ij,ij->i", unit[a], unit[b]) >= space.cosine)
                        a, b = a[linked], b[linked]
                        if not len(a):
                            continue
                        links += np.bincount(a, mult[b], len(reps)).astype(np.int64)
                        links += np.bincount(b, mult[a], len(reps)).astype(np.int64)
                        new = root[a] != root[b]
                        if new.any():
                            root = local_roots(len(reps), root[a[new]], root[b[new]])[root]
            used = np.flatnonzero(links)
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(reps[used]), pa.array(links[used]), pa.array(reps[root[used]])],
                                                 names=["rep", "links", "root"])
    return compare


def _meetings(dealt: DataFrame, part: int) -> DataFrame:
    """Deal the vectors at home in a cell into blocks of about ``part``, and
    those from other cells into blocks of twice as many.  Blocks at home meet
    each other and all from other cells; a block meets itself where it meets
    the first of those.  Adds ``pair`` and ``side``, see ``_compare``."""
    home = F.col("home").cast("long")
    # the vectors are dealt twice, once for the sizes, instead of being stored
    # as often as they are dealt; there are fewer cells than vectors by ``CELL``
    sizes = stored(dealt.groupBy("block", "cell").agg(F.ceil(F.sum(home) / part).alias("homes"), F.ceil(F.sum(1 - home) / (2 * part)).alias("far"))
                   .where("homes > 0"), "cells")
    own, other, homes = F.col("own"), F.col("other"), F.col("homes")
    zero = F.lit(0).cast("long")
    among = F.col("home") & (other < homes)
    return (dealt.join(F.broadcast(sizes), ["block", "cell"])
            .withColumn("own", F.pmod(F.xxhash64("rep"), F.when(F.col("home"), homes).otherwise(F.col("far"))))
            .withColumn("other", F.explode(F.sequence(zero, homes - 1 + F.when(F.col("home"), F.greatest("far", F.lit(1))).otherwise(0))))
            .where(~among | (own != other))
            .withColumn("lo", F.when(among, F.least("own", "other")).when(F.col("home"), own).otherwise(other))
            .withColumn("hi", F.when(among, F.greatest("own", "other")).when(F.col("home"), other).otherwise(homes + own))
            .withColumn("side", F.when(among, (own > other).cast("int")).when(F.col("home"), -(other == homes).cast("int")).otherwise(2))
            .select(F.xxhash64("block", "cell", "lo", "hi").alias("pair"), "block", "side", "rep", "mult", "vector"))


def _links(reps: DataFrame, dim: int, kind: str, cosine: float) -> DataFrame:
    mine = reps.where(F.col("dim") == dim)
    count = mine.count()
    wanted = max(SAMPLE, PER_CELL << tree_depth(count))
    # the draw of a vector is uniform, so about as many as wanted are read on
    chosen = mine.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < math.ceil(min(1.0, wanted / max(1, count)) * (1 << 30)))
    space = Space(dim, kind, cosine, count, [bytes(r["vector"]) for r in chosen.select("vector").collect()])
    dealt = mine.select("rep", "mult", "vector").mapInArrow(
        _deal(space), "block int, cell long, home boolean, rep long, mult long, vector binary")
    return by_key(_meetings(dealt, space.part), "pair").mapInArrow(_compare(space), "rep long, links long, root long")


def cosine_join(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id (the least id that links reach) from
    ``vectors`` (vec_id, embedding; other columns are left out)."""
    single = dict(vectors.dtypes)["embedding"] == "array<float>"
    kind, array = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(array).alias("embedding")) \
        .where("vec_id IS NOT NULL").mapInArrow(_read(kind), "vec_id long, dim int, digest binary, vector binary")
    one = Window.partitionBy("vec_id").orderBy("digest")
    rows = stored(rows.withColumn("_row", F.row_number().over(one)).where("_row = 1").drop("_row"), "vectors")
    valid = rows.where("dim > 0")
    classes = stored(valid.groupBy("digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("mult")), "classes")
    reps = stored(classes.join(rows.withColumnRenamed("vec_id", "rep"), ["rep", "digest"]).select("rep", "mult", "dim", "vector"), "reps")
    found = None
    for r in reps.select("dim").distinct().collect():  # as many as vectors have different lengths
        part = _links(reps, r["dim"], kind, cosine)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = stored(found, "links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_rep = (classes.join(links, "rep", "left").join(reached.withColumnRenamed("node", "rep"), "rep", "left")
              .select("digest", F.coalesce("component", "rep").alias("component_id"),
                      (F.col("mult") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return rows.select("vec_id", "dim", "digest").join(of_rep, "digest", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
