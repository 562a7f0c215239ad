"""Byte-level BPE encoding and decoding.

The vocabulary file (JSON with ``model.vocab``, ``model.merges`` and
``added_tokens``) is read by each Python worker once; its path must be
readable on every executor.  A text is cut into pieces by the vocabulary's
pattern, each piece becomes a doubly linked list of byte symbols, and a
priority queue of (merge rank, position) joins neighbours; an entry whose
symbols have meanwhile changed is stale and is skipped.  Pieces repeat, so
their ids are kept, within ``CACHE_BYTES`` a worker.  Decoding concatenates
the vocabulary's byte strings; broken UTF-8 becomes U+FFFD.  A few documents
of an Arrow batch are Python objects at a time.

Edge cases: null and empty texts have no ids and decode to the empty text;
the string of an added token in a text becomes that token's id; a text of
any length is encoded whole.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern that cuts texts before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# A space beside other white space; elsewhere a cut before each space is safe,
# as no piece goes on from something else into a space.
_LOOSE = re.compile(r"^\s| \s|\s |\s$")
_RARE_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]


def loose_space(text: str) -> bool:
    """Whether a space of ``text`` has white space beside it, or white space
    is at an end."""
    if "  " in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace():
        return True
    return any(c in text for c in _RARE_SPACES) and _LOOSE.search(text) is not None


LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
CACHE_BYTES = 192 << 20  # of stretches and of pieces, two thirds and one third
ENTRY_BYTES = 200       # about what an entry takes beside its characters and ids
CACHE_CHARS = 48        # longer stretches are not kept
SLICE = 256             # documents that are in Python at a time


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary:
    visible Latin-1 characters stand for themselves, the others for the code
    points from 256 on, in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(visible)]
    symbols = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [symbols[b] for b in range(256)]


class Merges:
    """The merge table: for each symbol on the left, the ranks by the symbol
    on the right."""

    def __init__(self, ranked: list[tuple[int, int, int]], symbols: int):
        self.left = [a for a, _, _ in ranked]
        self.right = [b for _, b, _ in ranked]
        self.joined = [c for _, _, c in ranked]
        tables: dict[int, dict[int, int]] = {}
        for rank, (a, b, _) in enumerate(ranked):
            tables.setdefault(a, {})[b] = rank
        self.rank = [tables.get(a, {}).get for a in range(symbols)]

    def apply(self, symbols: list[int]) -> list[int]:
        """Join neighbours, lowest rank first and leftmost first among equals.
        A queue entry is the rank, shifted, and the position."""
        n = len(symbols)
        if n < 2:
            return symbols
        ranks, left, right, joined = self.rank, self.left, self.right, self.joined
        shift = n.bit_length()
        mask = (1 << shift) - 1
        queue = []
        a = symbols[0]
        for i, b in enumerate(symbols[1:]):
            r = ranks[a](b)
            if r is not None:
                queue.append(r << shift | i)
            a = b
        if not queue:
            return symbols
        heapify(queue)
        symbols = [*symbols, -1]  # the sentinel ends the list
        after = list(range(1, n + 2))
        before = list(range(-1, n))
        while queue:
            entry = heappop(queue)
            i, r = entry & mask, entry >> shift
            if symbols[i] != left[r]:
                continue  # stale: merged since
            j = after[i]
            if symbols[j] != right[r]:
                continue  # stale: its neighbour has been merged since
            symbols[i] = c = joined[r]
            symbols[j] = -1
            after[i] = k = after[j]
            before[k] = i
            r = ranks[c](symbols[k])
            if r is not None:
                heappush(queue, r << shift | i)
            h = before[i]
            if h >= 0:
                r = ranks[symbols[h]](c)
                if r is not None:
                    heappush(queue, r << shift | h)
        return [s for s in symbols if s >= 0]


class Pieces(dict):
    """Cache from a stretch of text to its ids as bytes, emptied when it holds
    about ``most`` bytes."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.held = encode, most, 0

    def __missing__(self, stretch: str) -> bytes:
        ids = self.encode(stretch)
        if len(stretch) <= CACHE_CHARS:
            self.held += ENTRY_BYTES + len(stretch) + len(ids)
            if self.held > self.most:
                self.clear()
                self.held = 0
            self[stretch] = ids
        return ids


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        symbols = byte_symbols()
        self.byte_ids = [vocab[s] for s in symbols]
        of_symbol = {s: b for b, s in enumerate(symbols)}
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.added = added
        self.cut_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.strings = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], len(self.strings))
        for token, i in vocab.items():
            self.strings[i] = bytes(of_symbol[c] for c in token)
        for token, i in added.items():
            self.strings[i] = token.encode()
        self.find = regex.compile(PATTERN).findall
        self.pieces = Pieces(self._piece, CACHE_BYTES // 3)
        # the stretches of a text that follow a space, without that space
        self.later = Pieces(lambda s: self._stretch(" " + s), CACHE_BYTES * 2 // 3)

    def _piece(self, piece: str) -> bytes:
        ids = self.merges.apply([*map(self.byte_ids.__getitem__, piece.encode())])
        return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()

    def _stretch(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def _plain(self, text: str) -> bytes:
        if not text:
            return b""
        if loose_space(text):
            return self._stretch(text)
        stretches = text.split(" ")
        return self._stretch(stretches[0]) + b"".join(map(self.later.__getitem__, stretches[1:]))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.cut_added is None or not self.cut_added.search(text):
            return self._plain(text)
        return b"".join(np.array([self.added[s]], "<u4").tobytes() if s in self.added else self._plain(s)
                        for s in self.cut_added.split(text))

    def decode(self, ids: bytes | None) -> str:
        if not ids:
            return ""
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _slices(column: pa.Array, apply, kind: pa.DataType) -> pa.Array:
    """``apply`` to a few values of the column at a time."""
    parts = [pa.array([apply(x) for x in column.slice(lo, SLICE).to_pylist()], kind) for lo in range(0, len(column), SLICE)]
    return pa.chunked_array(parts, kind).combine_chunks() if parts else pa.array([], kind)


def encode_column(text: Column, path: str) -> Column:
    """Binary column: the ids of ``text`` as little-endian unsigned 32-bit
    integers.  The row's other columns stay in the JVM."""
    @F.arrow_udf("binary")
    def ids(texts: pa.Array) -> pa.Array:
        return _slices(texts, encoder(path).encode, pa.binary())
    return ids(text)


def decode_column(ids: Column, path: str) -> Column:
    """String column: the text of ids that ``encode_column`` gave.  On ids
    that the same plan encodes, ``round_trip_column`` encodes once, not twice."""
    @F.arrow_udf("string")
    def text(rows: pa.Array) -> pa.Array:
        return _slices(rows, encoder(path).decode, pa.string())
    return text(ids)


def round_trip_column(text: Column, path: str) -> Column:
    """struct(ids, decoded): the ids of ``text`` and the text decoded from
    them, in one pass."""
    @F.arrow_udf("ids binary, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        known = encoder(path)
        ids = _slices(texts, known.encode, pa.binary())
        return pa.StructArray.from_arrays([ids, _slices(ids, known.decode, pa.string())], names=["ids", "decoded"])
    return both(text)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
