"""SentencePiece encoding and decoding for vocabularies of merges (BPE).

The model file is read by each Python worker once; its path must be readable
on every executor.  A text is normalised as the model says (a space becomes
U+2581, one stands in front), its characters are the first symbols, and an
agenda of adjacent pairs, ordered by the score of the joined piece and then
by place, joins them until no pair is a piece.  A pair that has meanwhile
changed is stale and is skipped.  A symbol that is no piece becomes its bytes
where the model has byte pieces, else the unknown id.  Short stretches of
pieces go through the agenda side by side, a join each at a time
(``Vocabulary.encode_short``); the others one by one.

No piece goes on from another character into U+2581, and none holds a line
break beside anything else (both are read off the vocabulary; otherwise texts
stay whole), so a text is cut there and the ids of stretches are kept, within
``CACHE_BYTES``; marks behind a word are a stretch of their own where no piece
holds the two characters that meet there.  ``check=True`` also gives every stretch that is new in some
documents of an Arrow batch to the sentencepiece library, in one call, and
raises an error where it does not agree.  Arrow cuts the texts, finds the
different stretches, and joins ids and pieces again.

Edge cases: null and empty texts have no ids and decode to the empty text; a
text of any length is encoded whole; ids of control pieces decode to nothing;
bytes that are no UTF-8 decode to one U+FFFD each.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import cached_property, lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .bpe import LITTLE
from .common import cut_by_space, join_taken, no_collection

MARKS = ".,;:!?'\"()[]{}<>|&#$%*+-=/\\_~^`@"
SPACE = "▁"
CACHE_BYTES = 128 << 20  # of a worker's stretches, with what Python holds beside them
ENTRY_BYTES = 200        # about what a stretch takes beside its characters and ids
SHORT = 32               # characters of the stretches that are encoded side by side
CACHE_CHARS = 48         # longer stretches are not kept
SLICE = 512              # documents that are in Python at a time
# Types of pieces in the model file.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
NO_RANK = np.iinfo(np.int32).max


class Pairs:
    """The pairs of symbols that join, as sorted arrays.  Symbols are numbered:
    the pieces, and the characters that are none; any other character has the
    number behind them."""

    def __init__(self, rank: dict[str, int], ids: dict[str, int]):
        inner = [p for p in rank if len(p) > 1]
        symbol = {p: k for k, p in enumerate(dict.fromkeys(chain(rank, chain.from_iterable(inner))))}
        self.symbols = n = len(symbol)
        found = sorted((symbol[p[:i]] * n + symbol[p[i:]], rank[p], symbol[p])
                       for p in inner for i in range(1, len(p)) if p[:i] in symbol and p[i:] in symbol)
        # behind the pairs that join stands one that does not
        self.key = np.array([k for k, _, _ in found] + [np.iinfo(np.int64).max], np.int64)
        self.rank = np.array([r for _, r, _ in found] + [NO_RANK], np.int32)
        self.joined = np.array([j for _, _, j in found] + [0], np.int32)
        self.id = np.array([ids[p] if p in rank else -1 for p in symbol] + [-1], np.int32)
        self.of_char = np.full(sys.maxunicode + 1, n, np.int32)
        for p, k in symbol.items():
            if len(p) == 1:
                self.of_char[ord(p)] = k

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs of symbols among those that join."""
        key = left.astype(np.int64) * self.symbols + right
        at = np.searchsorted(self.key, key)
        at[(self.key[at] != key) | (right == self.symbols)] = len(self.key) - 1
        return at.astype(np.int32)


class Vocabulary:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        with open(path, "rb") as f:
            blob = f.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(blob)
        if model.trainer_spec.model_type != BPE:
            raise ValueError(f"{path}: not a vocabulary of merges")
        self.library = SentencePieceProcessor(model_proto=blob)
        self.pieces = [p.piece for p in model.pieces]
        self.types = [p.type for p in model.pieces]
        if USER_DEFINED in self.types:
            raise ValueError(f"{path}: user-defined pieces are not supported")
        self.unknown = self.types.index(UNKNOWN)
        spec = model.normalizer_spec
        self.prefix, self.strips = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.identity = not spec.precompiled_charsmap and spec.escape_whitespaces and not self.strips
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (NORMAL, UNUSED)}
        # equal scores have equal ranks; the highest score comes first
        scores = sorted({model.pieces[i].score for i in self.ids.values()}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        self.rank = {p: place[model.pieces[i].score] for p, i in self.ids.items()}
        self.unused = {p for p, i in self.ids.items() if self.types[i] == UNUSED}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.types[i] == BYTE}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        inner = [p for p in self.ids if len(p) > 1]
        self.meet = {p[i:i + 2] for p in inner for i in range(len(p) - 1)}
        self.control = {i for i, k in enumerate(self.types) if k == CONTROL}
        # what each id adds to a text
        self.raw = [" ⁇ ".encode() if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE
                    else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.types)]
        self.cuts = bool(self.bytes) and not any("\n" in p or re.search(f"[^{SPACE}]{SPACE}", p) for p in inner)

    def normal(self, text: str) -> str:
        if not text:
            return ""
        if self.identity:
            return (SPACE if self.prefix else "") + text.replace(" ", SPACE)
        return self.library.normalize(text)

    def symbols(self, text: str) -> list[str]:
        """The pieces of a normalised text."""
        n = len(text)
        symbols: list[str | None] = [*text, None]
        after, before = list(range(1, n + 2)), list(range(-1, n))
        rank, parts = self.rank, {}
        agenda = [(r, i, p) for i in range(n - 1) if (r := rank.get(p := text[i:i + 2])) is not None]
        heapify(agenda)
        while agenda:
            _, i, piece = heappop(agenda)
            left, j = symbols[i], after[i]
            if left is None or (right := symbols[j]) is None or len(left) + len(right) != len(piece):
                continue  # stale: one of the two has been joined since
            if piece in self.unused:
                parts[piece] = left, right
            symbols[i], symbols[j] = piece, None
            after[i] = k = after[j]
            if k <= n:
                before[k] = i
            if k < n and (r := rank.get(p := piece + symbols[k])) is not None:
                heappush(agenda, (r, i, p))
            h = before[i]
            if h >= 0 and (r := rank.get(p := symbols[h] + piece)) is not None:
                heappush(agenda, (r, h, p))
        out = [s for s in symbols if s is not None]
        if parts:  # an unused piece is taken apart again as it was joined
            todo, out = out[::-1], []
            while todo:
                s = todo.pop()
                if s in parts:
                    todo += parts[s][::-1]
                else:
                    out.append(s)
        return out

    def encode_normal(self, text: str) -> list[int]:
        """Ids of a normalised text."""
        out: list[int] = []
        for s in self.symbols(text):
            i = self.ids.get(s)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out += [self.bytes[b] for b in s.encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:  # unknown symbols in a row are one
                out.append(self.unknown)
        return out

    @cached_property
    def pairs(self) -> Pairs:
        return Pairs(self.rank, self.ids)

    def encode_short(self, texts: list[str]) -> dict[str, bytes]:
        """Ids of normalised texts as little-endian unsigned 32-bit integers,
        of those that end in pieces alone.  Texts of a length are the rows of
        a matrix of symbols; each round joins in every row the pair that its
        agenda has first, and sets aside the rows where no pair joins."""
        out: dict[str, bytes] = {}
        if self.unused:
            return out
        table, lengths = self.pairs, {}
        for t in texts:
            lengths.setdefault(len(t), []).append(t)
        for n, same in lengths.items():
            chars = np.frombuffer("".join(same).encode("utf-32-le", "surrogatepass"), "<u4")
            symbols = table.of_char[chars].reshape(-1, n)
            rows, pairs = np.arange(len(same)), table.find(symbols[:, :-1], symbols[:, 1:])
            while len(rows):
                if pairs.shape[1]:
                    first = table.rank[pairs].argmin(axis=1)  # the leftmost among equals
                    best = pairs[np.arange(len(rows)), first]
                    ended = table.rank[best] == NO_RANK
                else:
                    ended = np.ones(len(rows), bool)
                if ended.any():
                    ids = table.id[symbols[ended]]
                    whole = (ids >= 0).all(axis=1)
                    raw, step = ids[whole].astype("<u4").tobytes(), 4 * ids.shape[1]
                    for k, r in enumerate(rows[ended][whole].tolist()):
                        out[same[r]] = raw[k * step:(k + 1) * step]
                    left = ~ended
                    rows, symbols, pairs = rows[left], symbols[left], pairs[left]
                    if not len(rows):
                        break
                    first, best = first[left], best[left]
                at = np.arange(len(rows))
                behind = np.arange(symbols.shape[1] - 1) > first[:, None]
                symbols = np.where(behind, symbols[:, 1:], symbols[:, :-1])
                symbols[at, first] = table.joined[best]
                pairs = np.where(behind[:, :-1], pairs[:, 1:], pairs[:, :-1])
                for here, i in ((first > 0, first - 1), (first < pairs.shape[1], first)):
                    r, c = at[here], i[here]
                    pairs[r, c] = table.find(symbols[r, c], symbols[r, c + 1])
        return out

    def decode_rows(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """``decode`` of each stretch of ``ids`` between two ends."""
        if self.strips or self.control:
            special = np.zeros(len(self.pieces), bool)
            special[list(self.control)] = True
            odd = np.concatenate([[0], np.cumsum(special[ids])])
            apart = (odd[ends[1:]] > odd[ends[:-1]]) | self.strips
        else:
            apart = np.zeros(len(ends) - 1, bool)
        joined = join_taken(pa.array(ends.astype(np.int32)), self.raw, pa.array(ids))
        out = []
        for a, b, by_itself, raw in zip(ends[:-1].tolist(), ends[1:].tolist(), apart.tolist(), joined):
            try:
                # pieces are whole characters, so all is UTF-8 only if each run of bytes is
                text = None if by_itself else raw.decode()
            except UnicodeDecodeError:
                text = None
            if text is None:
                text = self._decode_runs(ids[a:b].tolist())
            elif self.prefix and a < b and self.pieces[ids[a]][:1] == SPACE:
                text = text[1:]
            out.append(text)
        return out

    def decode(self, ids: list[int]) -> str:
        if not ids or self.strips or not self.control.isdisjoint(ids):
            return self._decode_runs(ids)
        try:
            # pieces are whole characters, so all is UTF-8 only if each run of bytes is
            text = b"".join(map(self.raw.__getitem__, ids)).decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids)
        return text[1:] if self.prefix and self.pieces[ids[0]][:1] == SPACE else text

    def _decode_runs(self, ids: list[int]) -> str:
        """Pieces one by one, each run of bytes by itself."""
        out: list[str] = []
        run = bytearray()
        first = True  # nothing but U+2581 in front has been met

        def flush():
            nonlocal first
            if run:
                out.append(_utf8(bytes(run)))
                run.clear()
                first = False
        for i in ids:
            if i in self.of_byte:
                run.append(self.of_byte[i])
                continue
            flush()
            kind = self.types[i]
            if kind == CONTROL:
                continue
            if kind == UNKNOWN:
                out.append(" ⁇ ")
                first = False
                continue
            piece = self.pieces[i]
            if first and (self.prefix or self.strips):
                shorter = piece.lstrip(SPACE) if self.strips else piece.removeprefix(SPACE)
                if not self.strips or shorter:
                    first = False
                piece = shorter
            else:
                first = False
            out.append(piece.replace(SPACE, " "))
        flush()
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """Bytes as text; a byte that starts no valid sequence is one U+FFFD."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[i:i + n].decode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            n = 1
        i += n
    return "".join(out)


class Encoder:
    """A vocabulary with the ids of the stretches met lately."""

    def __init__(self, path: str, check: bool):
        self.vocabulary, self.check = Vocabulary(path), check
        self.known: dict[str, bytes] = {}
        self.held = 0
        stretch = f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if self.vocabulary.cuts else r"(?s).+"
        self.find = re.compile(stretch).findall

    def _verified(self, stretches: list[str]) -> None:
        """Compare with the library.  A stretch without U+2581 in front is
        given to it behind a line break."""
        v = self.vocabulary
        plain = v.identity and v.prefix
        bare = [s if not plain else s[1:].replace(SPACE, " ") if s[0] == SPACE else "\n" + s for s in stretches]
        lead = len(v.library.encode("\n"))
        found = v.library.encode(bare, num_threads=1) if plain else []
        want = [ids if s[0] == SPACE else ids[lead:] for s, ids in zip(stretches, found)]
        have = [self.known[s] for s in stretches[:len(want)]]
        if [4 * len(ids) for ids in want] == [*map(len, have)] and _packed([*chain.from_iterable(want)]) == b"".join(have):
            return
        for s, ids in zip(stretches, want):
            if s != SPACE and _packed(ids) != self.known[s]:
                raise RuntimeError(f"the library encodes {s!r} as {ids}")

    def _spaced(self, text: str) -> str | None:
        """The text with a space at each cut; None where that is not so simple."""
        v = self.vocabulary
        if not (v.identity and v.prefix and v.cuts) or "  " in text or SPACE in text or text[0] == " ":
            return None
        # the same cuts with spaces, of which a normalised text has none; empty stretches have no ids
        return SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")

    def _learn(self, new: set[str]) -> set[str]:
        """Make ``new`` known; returns what was added."""
        v, known = self.vocabulary, self.known
        marked, whole = {}, set(new)
        if v.cuts:
            words = {s: w for s in new if (w := s.rstrip(MARKS)) != s and w}
            marked = {s: w for s, w in words.items() if w[-1] + s[len(w)] not in v.meet}
            whole.difference_update(marked)
            whole.update(marked.values(), [s[len(w):] for s, w in marked.items()])
            whole.difference_update(known)
        whole.discard("")
        known.update(v.encode_short([s for s in whole if len(s) <= SHORT]))
        for s in whole.difference(known):
            known[s] = _packed(v.encode_normal(s))
        if self.check and whole:
            self._verified(list(whole))
        for s, w in marked.items():
            known[s] = known[w] + known[s[len(w):]]
        added = whole.union(new)
        self.held += sum([ENTRY_BYTES + len(s) + len(known[s]) for s in added])
        return added

    @no_collection()
    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        known, v = self.known, self.vocabulary
        spaced = [self._spaced(t) if t else "" for t in texts]
        simple = [i for i, t in enumerate(spaced) if t]
        others = {i: self.find(v.normal(texts[i])) for i, t in enumerate(spaced) if t is None}
        offsets, stretches, places = cut_by_space([spaced[i] for i in simple])
        new = set(stretches)
        for found in others.values():
            new.update(found)
        new.difference_update(known)
        new.discard("")
        known[""] = b""
        added = self._learn(new) if new else new
        out = [b""] * len(texts)
        for i, ids in zip(simple, join_taken(offsets, [*map(known.__getitem__, stretches)], places)):
            out[i] = ids
        for i, found in others.items():
            out[i] = b"".join(map(known.__getitem__, found))
        for s in added:
            if len(s) > CACHE_CHARS:
                self.held -= ENTRY_BYTES + len(s) + len(known.pop(s))
        if self.held > CACHE_BYTES:
            known.clear()
            self.held = 0
        return out


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str, check: bool = False) -> Encoder:
    return Encoder(path, check)


def encode_column(text: Column, path: str, check: bool = False) -> Column:
    """array<int> column: the ids of ``text``, without begin and end ids."""
    @F.arrow_udf("array<int>")
    def ids(texts: pa.Array) -> pa.Array:
        encode, out = encoder(path, check).encode, []
        for lo in range(0, len(texts), SLICE):
            rows = encode(texts.slice(lo, SLICE).to_pylist())
            ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
            out.append(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(rows), "<i4"))))
        return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.int32()))
    return ids(text)


def decode_column(ids: Column, path: str) -> Column:
    """String column: the text of ids that ``encode_column`` gave."""
    @F.arrow_udf("string")
    def text(rows: pa.Array) -> pa.Array:
        decode = encoder(path).vocabulary.decode
        return pa.chunked_array([pa.array([decode(r or []) for r in rows.slice(lo, SLICE).to_pylist()], pa.string())
                                 for lo in range(0, len(rows), SLICE)], pa.string()).combine_chunks()
    return text(ids)


def round_trip_column(text: Column, path: str, check: bool = False) -> Column:
    """struct(ids, decoded): both in one pass, so nothing is encoded twice."""
    @F.arrow_udf("ids array<int>, decoded string")
    def both(texts: pa.Array) -> pa.Array:
        known, out = encoder(path, check), []
        for lo in range(0, len(texts), SLICE):
            rows = known.encode(texts.slice(lo, SLICE).to_pylist())
            flat, ends = np.frombuffer(b"".join(rows), "<i4"), np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])])
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
            back = pa.array(known.vocabulary.decode_rows(flat, ends), pa.string())
            out.append(pa.StructArray.from_arrays([ids, back], names=["ids", "decoded"]))
        empty = pa.array([], pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())]))
        return pa.concat_arrays(out) if out else empty
    return both(text)
