"""Centroid clustering with Orchard's search for the nearest centroid.

Each centroid has the list of the others, sorted by their distance from it.
A vector walks along the list of its current centroid; when it meets a closer
one it goes on along that one's list from its start, centroids already
compared are not compared again, and it stops at the first neighbour that is
strictly beyond twice its current distance: by the triangle inequality none
from there on can be closer.  (At exactly twice, one may be as close, and ties
go to the smaller number.)  All vectors of an Arrow batch take their steps
together; those that have stopped leave.

Vectors are integers, floor(scale * x), so distances and sums are exact and
the result does not depend on how rows are dealt.  A round passes over the
stored vectors; tasks send sums per centroid, and the driver sees ``k``
centroids, never vectors.

Edge cases: vectors that are null, of another length, or hold a null or
non-finite component are left out; so are those with a component beyond
``LARGEST`` after scaling, as their squared distance has no long.  Repeated
rows and ids count one by one; with fewer than ``k`` vectors each is a
centroid; an empty centroid stays where it is; an empty table has no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LARGEST = 1 << 27
BATCH = 4096  # vectors that walk together


def whole_numbers(vector: Column, dimensions: int, scale: int) -> Column:
    """array<long>: floor(scale * x) of each component as a double; null where
    the vector is left out."""
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    fits = F.forall(scaled, lambda x: F.coalesce((F.abs(x) <= F.lit(float(LARGEST))) & ~F.isnan(x), F.lit(False)))
    return F.when((F.size(vector) == dimensions) & fits, F.transform(scaled, lambda x: F.floor(x).cast("long")))


class Orchard:
    """Centroids with their sorted neighbour lists."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        k = len(centroids)
        apart = ((self.centroids[:, None, :] - self.centroids[None, :, :]) ** 2).sum(axis=2)
        others = np.argsort(apart + np.where(np.eye(k, dtype=bool), np.int64(-1), np.int64(0)), axis=1, kind="stable")[:, 1:]
        self.neighbours = others
        self.apart = np.take_along_axis(apart, others, axis=1)
        self.compared = 0

    def _to(self, vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        self.compared += len(vectors)
        d = vectors - self.centroids[centroids]
        return np.einsum("ij,ij->i", d, d)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroid and squared distance of each vector."""
        n, k = len(vectors), len(self.centroids)
        best = np.zeros(n, np.int64)
        distance = self._to(vectors, best)
        place = np.zeros(n, np.int64)
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        walking = np.arange(n) if k > 1 else np.zeros(0, np.int64)
        while len(walking):
            at, on = best[walking], place[walking]
            # squared: beyond twice the distance is beyond four times its square
            walking = walking[self.apart[at, on] <= 4 * distance[walking]]
            met = self.neighbours[best[walking], place[walking]]
            place[walking] += 1
            fresh = ~visited[walking, met]
            who, met = walking[fresh], met[fresh]
            visited[who, met] = True
            d = self._to(vectors[who], met)
            closer = (d < distance[who]) | ((d == distance[who]) & (met < best[who]))
            jump = who[closer]
            best[jump], distance[jump], place[jump] = met[closer], d[closer], 0
            walking = walking[place[walking] < k - 1]
        return best, distance


def _vectors(batch: pa.RecordBatch, column: int, dimensions: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sum of each centroid's vectors."""
    k, dimensions = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                x = _vectors(batch.slice(lo, BATCH), 0, dimensions)
                cluster, _ = search.nearest(x)
                counts += np.bincount(cluster, minlength=k)
                np.add.at(sums, cluster, x)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "sums"])
    found = vectors.select("v").mapInArrow(partial, "cluster int, n long, sums array<long>")
    wide = F.array(*[F.sum(F.col("sums")[i].cast("decimal(38,0)")) for i in range(dimensions)])
    # k rows; a task's sum of at most 2 ** 36 components is exact
    rows = found.groupBy("cluster").agg(F.sum("n").alias("n"), wide.alias("sums")).collect()
    return {r["cluster"]: (r["n"], [int(s) for s in r["sums"]]) for r in rows}


def cluster(df: DataFrame, vec_id: str, vector: str, k: int, rounds: int, dimensions: int, scale: int = 256, seed: str = "2") -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia,
    centroid_sha256 and centroid (its components) of every vector kept."""
    vectors = stored(df.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vector), dimensions, scale).alias("v"))
                     .where("v IS NOT NULL"), "vectors")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(named, "v").limit(k).collect()  # k rows
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        for i, (n, sums) in _sums(vectors, centroids).items():
            centroids[i] = [s // n for s in sums]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                part = batch.slice(lo, BATCH)
                cluster, distance = search.nearest(_vectors(part, 1, dimensions))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])
    assigned = stored(vectors.select("vec_id", "v").mapInArrow(assign, "vec_id long, cluster int, distance long"), "clusters")
    inertia = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    total = inertia.agg(F.sum("own").cast("long").alias("inertia"))
    centre = df.sparkSession.createDataFrame(
        [(i, [int(x) for x in c], hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for i, c in enumerate(centroids)],
        "cluster int, centroid array<long>, centroid_sha256 string")
    # k rows at most
    per_cluster = (inertia.crossJoin(F.broadcast(total)).join(F.broadcast(centre), "cluster")
                   .select("cluster", F.col("own").cast("long").alias("cluster_inertia"), "inertia", "centroid_sha256", "centroid"))
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "centroid")
