"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point.  A
run of three letters (a break between words counts as a letter) is bound into
one vector: the product of the letters' vectors, each rolled by its place.
The sum of a text's trigram vectors is the text's vector; a language's
prototype is the sum of the unit vectors of its texts.  A text gets the
language of the prototype with the highest cosine, which is the score.

Fitting reads about ``PER_LANGUAGE`` texts of each language at most, chosen by
a hash of their id; tasks send sums, and the driver sees one vector per
language.

Edge cases: null texts and texts without a letter are ``und`` with score 0;
so is everything if no text has a language; case does not count; a negative
cosine scores 0; ties go to the first language by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
PER_LANGUAGE = 2_000
KNOWN_TRIGRAMS = 20_000  # kept by a worker at a time
STRETCH = 1 << 18
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of letters and breaks, and how often they occur;
    three code points of 21 bits, a break being 0."""
    keys, counts = [], []
    text = text.lower()
    for lo in range(0, len(text), STRETCH):
        part = text[max(0, lo - 2):lo + STRETCH] if lo else text[:STRETCH]
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        code = np.where(_letters()[code], code, 0).astype(np.uint64)
        code = np.concatenate([[0], code, [0]]).astype(np.uint64)
        code = code[np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])]
        if len(code) >= 3:
            k, n = np.unique(code[:-2] << np.uint64(42) | code[1:-1] << np.uint64(21) | code[2:], return_counts=True)
            real = (k != 0) & ((k >> np.uint64(21) & np.uint64(0x1FFFFF)) != 0)  # a letter stands in the middle
            keys.append(k[real])
            counts.append(n[real])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(keys) == 1:
        return keys[0], counts[0]
    k, place = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(place, np.concatenate(counts)).astype(np.int64)


class Memory:
    """The vectors of letters and of the trigrams met lately."""

    def __init__(self):
        self.letter: dict[int, np.ndarray] = {}
        self.clear()

    def clear(self):
        self.keys = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.rows = np.empty((0, DIMENSIONS), np.float32)

    def _room(self, n: int):
        """Place for ``n`` rows; the array doubles, so a row is seldom copied."""
        if n > len(self.rows):
            rows = np.empty((min(KNOWN_TRIGRAMS, max(n, 2 * len(self.rows))), DIMENSIONS), np.float32)
            rows[:len(self.keys)] = self.rows[:len(self.keys)]
            self.rows = rows

    def _of(self, code: int) -> np.ndarray:
        if code not in self.letter:
            self.letter[code] = np.random.default_rng([code, DIMENSIONS]).integers(0, 2, DIMENSIONS).astype(np.int8) * 2 - 1
        return self.letter[code]

    def bind(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self._of(a), 2) * np.roll(self._of(b), 1) * self._of(c)

    def vector(self, text: str | None) -> np.ndarray | None:
        """The sum of the trigram vectors; None without a letter."""
        keys, counts = trigrams(text or "")
        if not len(keys):
            return None
        at = np.searchsorted(self.keys, keys)
        new = keys[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != keys)] if len(self.keys) else keys
        if len(new):
            if len(self.letter) > 20_000:
                self.letter.clear()
            if len(new) > KNOWN_TRIGRAMS:  # more than a worker keeps: one by one
                total = np.zeros(DIMENSIONS)
                for k, n in zip(keys.tolist(), counts.tolist()):
                    total += n * self.bind(k).astype(np.float64)
                return total
            if len(self.keys) + len(new) > KNOWN_TRIGRAMS:
                self.clear()
                new = keys
            used = len(self.keys)
            self._room(used + len(new))
            for i, k in enumerate(new.tolist(), used):
                self.rows[i] = self.bind(k)
            self.place = np.concatenate([self.place, np.arange(used, used + len(new))])
            self.keys = np.concatenate([self.keys, new])
            order = np.argsort(self.keys)
            self.keys, self.place = self.keys[order], self.place[order]
        rows = self.rows[self.place[np.searchsorted(self.keys, keys)]]
        return (counts.astype(np.float32) @ rows).astype(np.float64)


@lru_cache(maxsize=1)
def memory() -> Memory:
    return Memory()


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the texts' unit vectors for each language of the task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            v = memory().vector(text.as_py())
            if v is not None and v.any():
                sums[lang] = sums.get(lang, 0) + v / np.linalg.norm(v)
    memory().clear()
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()])], names=["lang", "profile"])


def fit(docs: DataFrame, wanted: Column, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Names and unit prototypes of the languages of ``docs`` (doc_id, text,
    lang) where ``wanted`` holds and lang is not null."""
    rows = docs.where(wanted & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    counts = rows.groupBy("lang").count().collect()  # one row per language
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], min(1.0, per_language / r["count"])).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(1 << 20)) / float(1 << 20)
    parts = rows.where(drawn < share).select("text", "lang").mapInArrow(_profiles, "lang string, profile array<double>")
    sums = (parts.select("lang", F.posexplode("profile").alias("axis", "value")).groupBy("lang", "axis")
            .agg(F.sum("value").alias("value")).collect())  # one vector per language
    names = sorted({r["lang"] for r in sums})
    prototypes = np.zeros((len(names), DIMENSIONS))
    for r in sums:
        prototypes[names.index(r["lang"]), r["axis"]] = r["value"]
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
    return names, prototypes / np.where(norms > 0, norms, 1)


def predict(text: Column, model: tuple[list[str], np.ndarray]) -> Column:
    """struct(lang_pred, score)."""
    names, prototypes = model

    @F.pandas_udf("lang_pred string, score double")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for text in texts:
                v = memory().vector(text) if names else None
                norm = 0.0 if v is None else float(np.linalg.norm(v))
                if v is None:
                    out.append((UNKNOWN, 0.0))
                    continue
                cosine = prototypes @ (v / (norm or 1.0))  # a sum of zero is as near to every language
                best = int(cosine.argmax())
                out.append((names[best], float(min(1.0, max(0.0, cosine[best])))))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])
        memory().clear()  # the worker goes on to other tasks
    return column(text)
