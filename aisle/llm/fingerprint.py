"""One-permutation MinHash fingerprints of documents.

Each shingle is hashed once; the top bits of the hash choose a bin, a bin
keeps its least hash.  An empty bin borrows from the bin that a fixed random
sequence of its own reaches first (optimal densification).  The fingerprint
is the low-order bits of all bins, packed, in hexadecimal.  Two fingerprints
agree in a bin with probability J + (1 - J) / 2^bits, from which the
likeness, an estimate of the Jaccard similarity J, is corrected.

Edge cases: a text without words (null, empty, white space) has the empty
fingerprint, whose likeness is 1 to itself and 0 to any other; the likeness
lies between 0 and 1.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions
from .shingles import mix64, shingles

BINS = 512
BITS = 4
_TRIES = 64
# the sequence of bins that an empty bin asks
_ASK = (mix64(np.arange(BINS * _TRIES, dtype=np.uint64) + np.uint64(1)) % np.uint64(BINS)).astype(np.int64).reshape(BINS, _TRIES)


def bins(text: str | None) -> np.ndarray | None:
    """The low-order bits of every bin; None for a text without words."""
    hashes = shingles(text)
    if not len(hashes):
        return None
    shift = np.uint64(64 - int(np.log2(BINS)))
    of = (hashes >> shift).astype(np.int64)
    first = np.flatnonzero(np.diff(of, prepend=-1))  # ascending, so the least of each bin
    value = np.zeros(BINS, np.uint8)
    filled = np.zeros(BINS, bool)
    # the low bits of the least hash, scrambled, as the hash is small in its bin
    value[of[first]] = (mix64(hashes[first]) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    filled[of[first]] = True
    empty = np.flatnonzero(~filled)
    ask = _ASK[empty]
    lap = 0
    while len(empty):
        hit = filled[ask]
        got = hit.any(axis=1)
        value[empty[got]] = value[ask[got, hit[got].argmax(axis=1)]]
        empty = empty[~got]
        lap += 1
        ask = (mix64((_ASK[empty] + BINS * lap * (empty[:, None] + 1)).astype(np.uint64)) % np.uint64(BINS)).astype(np.int64)
    return value


def pack(value: np.ndarray | None) -> str:
    if value is None:
        return ""
    return np.packbits(np.unpackbits(value[:, None], axis=1)[:, 8 - BITS:].ravel()).tobytes().hex()


def unpack(fingerprint: str) -> np.ndarray | None:
    if not fingerprint:
        return None
    flat = np.unpackbits(np.frombuffer(bytes.fromhex(fingerprint), np.uint8)).reshape(BINS, BITS)
    return np.packbits(np.concatenate([np.zeros((BINS, 8 - BITS), np.uint8), flat], axis=1), axis=1).ravel()


def likeness_of(a: np.ndarray | None, b: np.ndarray | None) -> float:
    if a is None or b is None:
        return float(a is None and b is None)
    chance = 1 / (1 << BITS)
    return float(min(1.0, max(0.0, ((a == b).mean() - chance) / (1 - chance))))


def fingerprint(text: Column) -> Column:
    @F.pandas_udf("string")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series([pack(bins(t)) for t in texts], dtype=object)
    return column(text)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint columns."""
    @F.pandas_udf("double")
    def column(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([likeness_of(unpack(x or ""), unpack(y or "")) for x, y in zip(left, right)])
    return column(a, b)


def with_next(docs: DataFrame, work, schema: str) -> DataFrame:
    """Run ``work(rows)`` over every document and the one that follows it in
    ascending doc_id (after the last: the first).  ``rows`` yields (doc_id,
    text, text of the next); ``work`` yields Arrow batches of ``schema``.

    The ids are cut into ranges at quantiles, and the ranges are dealt to
    tasks, so the texts are shuffled once; the first document of each range
    goes to the range before as well.  The driver sees a bound and an id per
    range.  A null id comes first; rows that repeat an id follow by text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = 4 * shuffle_partitions(docs.sparkSession)
    steps = F.array(*(F.lit((i + 1) / ranges) for i in range(ranges - 1)))
    cuts = docs.agg(F.percentile_approx("doc_id", steps, 100 * ranges)).first()[0]
    bounds = np.unique(np.array([] if cuts is None else cuts, np.int64))

    @F.arrow_udf("long")
    def range_of(ids: pa.Array) -> pa.Array:
        place = np.searchsorted(bounds, ids.fill_null(0).to_numpy(zero_copy_only=False), side="left")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), 0, place))  # nulls come first

    # one row per range: its least id, or that it holds a null id
    least = {r["range"]: (r["id"], r["nulls"]) for r in docs.select("doc_id", range_of("doc_id").alias("range"))
             .groupBy("range").agg(F.min("doc_id").alias("id"), F.max(F.col("doc_id").isNull()).alias("nulls")).collect()}
    order = sorted(least)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the first range follows the last
    heads_of = [(None if least[r][1] else least[r][0], before[r]) for r in order]
    dealt = docs.withColumn("range", range_of("doc_id")).withColumn("head", F.lit(False))
    if heads_of:
        ids = docs.sparkSession.createDataFrame(heads_of, "id long, range long")
        heads = (docs.join(F.broadcast(ids), docs.doc_id.eqNullSafe(ids.id))
                 .select("doc_id", "text", "range", F.lit(True).alias("head")))
        dealt = dealt.union(heads)
    dealt = dealt.repartition("range").sortWithinPartitions("range", "head", F.col("doc_id").asc_nulls_first(), "text")

    def pairs(batches: Iterator[pa.RecordBatch]):
        held = None  # the last document, until the next one is known
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, of, head = (batch.column(k)[i].as_py() for k in range(4))
                if held is not None and held[2] == of:
                    yield held[0], held[1], text
                    held = None
                if not head:
                    held = (doc_id, text, of)

    return dealt.mapInArrow(lambda batches: work(pairs(batches)), schema)


COMPARED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
            "near_edited double, near_next double")


def compare(rows) -> Iterator[pa.RecordBatch]:
    """Fingerprints of each text and of its edited text: the later half of
    its characters replaced by as many of the next document's first ones."""
    names = [c.split()[0] for c in COMPARED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    out: list[tuple] = []
    ahead: tuple[str, np.ndarray | None] | None = None
    for doc_id, text, following in rows:
        mine = ahead[1] if ahead is not None and ahead[0] is text else bins(text)
        ahead = (following, bins(following))
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        other = bins(edited)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), pack(mine), pack(other),
                    likeness_of(mine, other), likeness_of(mine, ahead[1])))
        if len(out) == 256:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
