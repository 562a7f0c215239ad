"""Helpers that several operators share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its work runs once,
    and a lost executor costs no more than the stage it was in."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(doc_id, divisor: int):
    """crc32 of the id as text modulo ``divisor``; a null id counts as the
    empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def text_or_empty(col):
    return F.coalesce(col, F.lit(""))


def key_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal ``key`` in batches that are sorted by it, one table
    each; a run may span batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(k[1:] != k[:-1]) + 1).tolist(), len(k)]
        for lo, hi in zip(cuts, cuts[1:]):
            if held and k[lo] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(lo, hi - lo))
            last = k[lo]
    if held:
        yield pa.Table.from_batches(held)


def by_key(df: DataFrame, key: str) -> DataFrame:
    """All rows of a key in one task, next to each other."""
    return df.repartition(key).sortWithinPartitions(key)


def local_roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and undirected edges, the smallest node that each one
    reaches."""
    root = np.arange(n)
    while len(left):
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, left, low)
        np.minimum.at(root, right, low)
        np.minimum.at(root, before[left], low)
        np.minimum.at(root, before[right], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def cut_by_space(texts: list[str]) -> tuple[pa.Array, list[str], pa.Array]:
    """The texts cut at each space: where each text's stretches begin, the
    different stretches, and the place among these of each one."""
    cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    found = cut.values.dictionary_encode()
    n = len(found.dictionary)
    if not n:
        return cut.offsets, [], found.indices
    # no stretch holds a space, so all of them pass as one string
    together = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), found.dictionary), pa.scalar(" ", pa.large_string()))
    return cut.offsets, together[0].as_py().split(" "), found.indices


@contextmanager
def no_collection() -> Iterator[None]:
    """Without the cyclic garbage collector, which would go through the long
    lists of strings of a slice again and again; they hold no cycles."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def join_taken(offsets: pa.Array, values: list[bytes], places: pa.Array) -> list[bytes]:
    """For each row between two offsets, the ``values`` at its places, joined."""
    taken = pc.take(pa.array(values, pa.large_binary()), places)
    return pc.binary_join(pa.ListArray.from_arrays(offsets, taken), pa.scalar(b"", pa.large_binary())).to_pylist()
