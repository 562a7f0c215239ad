"""Hashes of the runs of five words of a text.

A word is a run of characters other than space and U+0009 to U+000D; case and
punctuation count.  A text with one to four words has one shingle of all of
them, a text without words has none.  Words and shingles are 64-bit hashes,
computed on the UTF-8 bytes a stretch at a time, so working memory does not
grow with the text (the set of its shingles does).
"""

from __future__ import annotations

import numpy as np

WORDS = 5
STRETCH = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, base))])


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UP = _powers(_BASE, 1 << 12)
_DOWN = _powers(_INVERSE, 1 << 12)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        _UP, _DOWN = _powers(_BASE, 2 * n), _powers(_INVERSE, 2 * n)
    return _UP, _DOWN


def mix64(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: bytes) -> np.ndarray:
    """A hash for each word of ``data``: a polynomial of its bytes, taken
    from prefix sums, and its length."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(np.concatenate([[True], _SPACE[raw], [True]]).view(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _tables(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _stretches(data: bytes):
    """Parts of ``data`` that end at white space."""
    lo = 0
    while lo < len(data):
        hi = lo + STRETCH
        if hi < len(data):
            while hi < len(data) and not _SPACE[data[hi]]:
                hi += 1
        yield data[lo:hi]
        lo = hi


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    if not text:
        return np.zeros(0, np.uint64)
    data = text.encode("utf-8", "surrogatepass")
    held, found = np.zeros(0, np.uint64), []
    for part in _stretches(data) if len(data) > STRETCH else (data,):
        held = np.concatenate([held, word_hashes(part)]) if len(held) else word_hashes(part)
        if len(held) >= words:
            found.append(_combine(held, words))
            held = held[len(held) - words + 1:]
    if not found:
        return _combine(held, len(held)) if len(held) else held
    return np.unique(np.concatenate(found) if len(found) > 1 else found[0])


def _combine(hashes: np.ndarray, words: int) -> np.ndarray:
    n = len(hashes) - words + 1
    total = np.zeros(n, np.uint64)
    for k in range(words):
        total = total * _BASE + hashes[k:k + n]
    return mix64(total)
