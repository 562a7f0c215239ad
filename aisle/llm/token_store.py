"""Token ids as an ORC store in document order.

Documents are dealt by ranges of their id, encoded with the tokenizers
library, and written as ORC: one file per range, sorted by id, with integer
run-length encoding of the ids, a row index every ``ROW_INDEX_STRIDE`` rows
and a Bloom filter on the document id, so a reader takes stripes in parallel
and skips those that cannot hold an id.  A row knows its place in its file; a
manifest of one row per file says how many ids come before the file.

Edge cases: null and empty texts hold the end id alone; a null id sorts
first; rows that repeat an id sort by their text; an empty table gives an
empty store.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import LITTLE, byte_symbols, loose_space
from .common import cut_by_space, join_taken, no_collection, shuffle_partitions

ROW_INDEX_STRIDE = 1000
CACHE_BYTES = 320 << 20  # of a worker's stretches, with what Python holds beside them
ENTRY_BYTES = 240        # what a kept stretch and its ids take at most, in CPython
CACHE_CHARS = 48         # longer stretches are not kept
SLICE = 512              # documents that are in Python at a time
WORDS = 20_000           # words that the model takes in one row
SCHEMA = "part int, place long, local_start long, doc_id long, n_tokens long, ids array<int>"


class LibraryEncoder:
    """The tokenizers library behind a cache of the stretches between spaces.

    Its byte-level pattern never goes on from another character into a space
    or a line break, nor from a line break into anything but white space, so a
    text without loose white space can be cut there.  A stretch is what
    follows a space, or a line break with what follows it.  The new stretches
    of some documents go through the library together: words of letters, which
    are one piece each, straight to its model, the full stops and commas
    behind them apart, and the others as they are.  Arrow cuts the documents,
    finds the different stretches and joins their ids again, so Python meets
    each stretch once in a slice of documents."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = Tokenizer(self.library.model)  # the same vocabulary, without cutting
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.symbols = dict(enumerate(byte_symbols()))
        vocabulary = self.library.get_vocab()
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.lengths[i] = len(token)
        self.line_break = self._library(["\n"])[0]
        self.known: dict[str, bytes] = {}
        self.ends: dict[str, bytes] = {}
        self.held = 0

    def _library(self, texts: list[str]) -> list[bytes]:
        return _ids(self.library.encode_batch_fast(texts, add_special_tokens=False))

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters with a space in front."""
        together = " ".join(words)
        if not together.isascii():
            words = together.encode().decode("latin-1").translate(self.symbols).split(self.symbols[32])
        space = self.symbols[32]
        spaced = [space + w for w in words]
        out: list[bytes] = []
        for lo in range(0, len(spaced), WORDS):
            out += self._pieces(spaced[lo:lo + WORDS])
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces in the symbols of the vocabulary.  They come in one
        row from the model, and the lengths of the tokens say where a piece ends."""
        ids = np.array(self.model.encode_batch_fast([pieces], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        reach = np.cumsum(self.lengths[ids])
        want = np.cumsum([len(p) for p in pieces])
        ends = np.searchsorted(reach, want)
        if not len(ids) or ends[-1] >= len(ids) or (reach[ends] != want).any():  # a symbol that is no token was left out
            return _ids(self.model.encode_batch_fast(pieces, add_special_tokens=False))
        raw, cuts = ids.tobytes(), (4 * ends + 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)]

    def learn(self, stretches: set[str]) -> list[str]:
        """Make all of ``stretches`` known; returns those not to be kept."""
        known = self.known
        new = stretches.difference(known)
        words = {s for s in new if s.isalpha()}
        others = new - words
        ended = {s: w for s in others if (w := s.rstrip(".,")) != s and w.isalpha()}
        ends = list({s[len(w):] for s, w in ended.items()}.difference(self.ends))
        self.ends.update(zip(ends, self._library(ends)))
        behind = set(ended.values())
        missing = list(words | behind.difference(known))
        found = dict(zip(missing, self._words(missing)))
        known.update(found)
        for s, w in ended.items():
            known[s] = known[w] + self.ends[s[len(w):]]
        plain = [s for s in others.difference(ended) if s[:1] != "\n"]
        broken = [s for s in others if s[:1] == "\n"]
        known.update(zip(plain, self._library([" " + s for s in plain])))
        known.update(zip(broken, [self.line_break + ids for ids in self._library([s[1:] for s in broken])]))
        self.held += ENTRY_BYTES * (len(missing) + len(others))
        return [s for s in [*missing, *others] if len(s) > CACHE_CHARS]

    def _cut(self, text: str) -> bool:
        return not (loose_space(text) or "\n\n" in text or (self.added is not None and self.added.search(text)))

    @no_collection()
    def encode(self, texts: list[str | None], end: bytes = b"") -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, and
        ``end`` behind them."""
        out: list[bytes] = [end] * len(texts)
        plain = [i for i, t in enumerate(texts) if t and self._cut(t)]
        rest = set(plain)
        whole = [i for i, t in enumerate(texts) if t and i not in rest]
        for i, ids in zip(whole, self._library([texts[i] for i in whole])):
            out[i] = ids + end
        # a line break in front of each text, taken off its ids again
        offsets, stretches, places = cut_by_space([f"\n{texts[i]}".replace("\n", " \n")[1:] for i in plain])
        long = self.learn(set(stretches))
        front = len(self.line_break)
        for i, ids in zip(plain, join_taken(offsets, [*map(self.known.__getitem__, stretches)], places)):
            out[i] = ids[front:] + end
        for s in long:
            del self.known[s]
            self.held -= ENTRY_BYTES
        if self.held > CACHE_BYTES:
            self.known.clear()
            self.ends.clear()
            self.held = 0
        return out


def _ids(encodings) -> list[bytes]:
    return [array("I", e.ids).tobytes() if LITTLE else np.array(e.ids, "<u4").tobytes() for e in encodings]


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def write_store(docs: DataFrame, path: str, vocabulary: str, end_id: int, files: int | None = None) -> None:
    """Write ``docs`` (doc_id, text; other columns are left out) to the folder
    ``path``: ``tokens`` (ORC) and ``manifest``."""
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encoder = library_encoder(vocabulary)
        end = np.array([end_id], "<i4").tobytes()
        place = start = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo in range(0, batch.num_rows, SLICE):  # a few documents at a time leave Python
                rows = encoder.encode(texts.slice(lo, SLICE).to_pylist(), end)
                n = np.array([len(r) // 4 for r in rows], np.int64)
                ends = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(rows), part, np.int32)),
                    pa.array(place + np.arange(len(rows))),
                    pa.array(start + ends[:-1]),
                    ids.slice(lo, SLICE), pa.array(n),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), "<i4"))),
                ], names=["part", "place", "local_start", "doc_id", "n_tokens", "ids"])
                place += len(rows)
                start += int(ends[-1])

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(files or shuffle_partitions(spark), "doc_id")
               .sortWithinPartitions("doc_id", "text"))
    (ordered.mapInArrow(encode, SCHEMA).write
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.create.index", "true")
     .option("orc.row.index.stride", str(ROW_INDEX_STRIDE))
     .option("compression", "zstd")
     .orc(f"{path}/tokens"))
    # one row per file: the order of the files is the order of the documents
    sums = spark.read.orc(f"{path}/tokens").groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
     .coalesce(1).write.parquet(f"{path}/manifest"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    tokens = spark.read.schema(SCHEMA).orc(f"{path}/tokens")
    manifest = spark.read.schema("part int, base long").parquet(f"{path}/manifest")
    # one row per file, so its size is bounded by the number of written files
    return (tokens.join(F.broadcast(manifest), "part")
            .select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids"))


def ids_crc32(ids: Column) -> Column:
    """CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    @F.arrow_udf("long")
    def crc(column: pa.Array) -> pa.Array:
        values = np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False), "<i4")
        ends = column.offsets.to_numpy()
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())
    return crc(ids)
