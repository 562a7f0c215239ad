"""Quality classifier: a generalised additive model with pairwise terms.

A text becomes a few numbers (lengths, shares of kinds of characters and
words, repetition).  Each number is cut into bins, and the model adds a table
entry per number and per chosen pair of numbers to a base.  The tables are
learned by cyclic boosting: in each round every number in turn gets a shallow
tree over its bins, fitted to the gradient of the log loss; then pairs do,
with a cut on either side, chosen by how much they still explain.

Fitting reads ``ROWS`` labelled texts at most, chosen by a hash of their id,
and only their numbers reach the driver.  Scores are looked up bin by bin for
whole batches.

Edge cases: null and empty texts have numbers of their own (all zero) and so
a score; without labels, or with labels of one kind, every score is the share
of label 1 (1 without labels); null labels are left out; a repeated label
counts again.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS = 20_000
NUMBERS = ("length", "words", "word_length", "distinct_words", "repeated_neighbour", "top_word", "wordless", "upper_words", "capital_words",
           "letters", "upper", "digits", "symbols", "spaces", "doubled_symbols", "line_length", "repeated_lines", "stops")
BINS = 32
PAIR_BINS = 8
PAIRS = 8
ROUNDS = 120
PAIR_ROUNDS = 60
RATE = 0.15
# kinds of characters
LOWER, UPPER, LETTER, DIGIT, SPACE, SYMBOL = range(6)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    def kind(c: str) -> int:
        if c.isalpha():
            return UPPER if c.isupper() else LOWER if c.islower() else LETTER
        return DIGIT if c.isnumeric() else SPACE if c.isspace() else SYMBOL
    return np.fromiter(map(kind, map(chr, range(0x110000))), np.uint8, 0x110000)


def numbers(text: str | None) -> list[float]:
    """The numbers of a text, in the order of ``NUMBERS``."""
    words = (text or "").split()
    if not words:
        return [0.0] * len(NUMBERS)
    n, m = len(text), len(words)
    seen = Counter(words)
    counts, doubled = np.zeros(6), 0
    for lo in range(0, n, 1 << 18):
        code = np.frombuffer(text[lo:lo + (1 << 18)].encode("utf-32-le", "surrogatepass"), "<u4")
        kind = _kinds()[code]
        counts += np.bincount(kind, minlength=6)
        doubled += int(((code[1:] == code[:-1]) & (kind[1:] == SYMBOL)).sum())
    letters = counts[[LOWER, UPPER, LETTER]].sum()
    lines = text.split("\n")
    return [np.log1p(n), np.log1p(m), (n - counts[SPACE]) / m, len(seen) / m, sum(map(eq, words, words[1:])) / m,
            max(seen.values()) / m, sum(k for w, k in seen.items() if not any(map(str.isalpha, w))) / m,
            sum(k for w, k in seen.items() if len(w) > 1 and w.isupper()) / m, sum(k for w, k in seen.items() if w[0].isupper()) / m,
            letters / n, counts[UPPER] / max(1, letters), counts[DIGIT] / n, counts[SYMBOL] / n, counts[SPACE] / n, doubled / n,
            np.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines), sum(k for w, k in seen.items() if w[-1] in ".?!") / m]


@dataclass
class Model:
    base: float
    edges: list[np.ndarray] = field(default_factory=list)       # of the bins of each number
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)      # from bins to the bins of pairs
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1) if self.edges else x[:, :0].astype(int)

    def logit(self, b: np.ndarray) -> np.ndarray:
        out = np.full(len(b), self.base)
        for j, t in enumerate(self.tables):
            out += t[b[:, j]]
        for (j, k), t in self.pairs.items():
            out += t[self.coarse[j][b[:, j]], self.coarse[k][b[:, k]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(self.bins(x))))


def _gain(g, h):
    return g * g / (h + 1.0)


def _step(g, h):
    return np.clip(g / (h + 1.0), -4, 4)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Leaf values of a tree with two cuts over ordered bins, from the sums of
    gradients and curvatures per bin."""
    parts = [(0, len(g))]
    for _ in range(2):
        best = None
        for lo, hi in parts:
            if hi - lo < 2:
                continue
            left_g, left_h = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            all_g, all_h = g[lo:hi].sum(), h[lo:hi].sum()
            gains = _gain(left_g, left_h) + _gain(all_g - left_g, all_h - left_h) - _gain(all_g, all_h)
            at = int(gains.argmax())
            if best is None or gains[at] > best[0]:
                best = (gains[at], lo, lo + at + 1, hi)
        if best is None or best[0] <= 0:
            break
        _, lo, cut, hi = best
        parts.remove((lo, hi))
        parts += [(lo, cut), (cut, hi)]
    out = np.zeros(len(g))
    for lo, hi in parts:
        out[lo:hi] = _step(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with a cut on either axis."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    a_g, a_h = cg[:-1, :-1], ch[:-1, :-1]
    top_g, top_h, left_g, left_h = cg[:-1, -1:], ch[:-1, -1:], cg[-1:, :-1], ch[-1:, :-1]
    b_g, b_h, c_g, c_h = top_g - a_g, top_h - a_h, left_g - a_g, left_h - a_h
    d_g, d_h = cg[-1, -1] - top_g - left_g + a_g, ch[-1, -1] - top_h - left_h + a_h
    gains = _gain(a_g, a_h) + _gain(b_g, b_h) + _gain(c_g, c_h) + _gain(d_g, d_h) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(gains.argmax()), gains.shape)
    out = np.empty(g.shape)
    for rows, cols, gg, hh in ((slice(0, i + 1), slice(0, j + 1), a_g, a_h), (slice(0, i + 1), slice(j + 1, None), b_g, b_h),
                               (slice(i + 1, None), slice(0, j + 1), c_g, c_h), (slice(i + 1, None), slice(j + 1, None), d_g, d_h)):
        out[rows, cols] = _step(gg[i, j], hh[i, j])
    return float(gains[i, j]), out


def boost(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit the tables to rows of numbers and labels 0 and 1."""
    share = y.mean() if len(y) else 1.0
    if share in (0.0, 1.0):
        return Model(40.0 if share else -40.0)
    model = Model(float(np.log(share / (1 - share))))
    steps = np.linspace(0, 1, BINS + 1)[1:-1]
    model.edges = [np.unique(np.quantile(x[:, j], steps)) for j in range(x.shape[1])]
    b = model.bins(x)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(s) for s in sizes]
    model.coarse = [np.arange(s) * min(s, PAIR_BINS) // s for s in sizes]
    c = np.stack([model.coarse[j][b[:, j]] for j in range(len(sizes))], axis=1)
    logit = np.full(len(y), model.base)
    for _ in range(ROUNDS):
        for j, size in enumerate(sizes):
            p = 1 / (1 + np.exp(-logit))
            update = RATE * _tree(np.bincount(b[:, j], y - p, size), np.bincount(b[:, j], p * (1 - p), size))
            model.tables[j] += update
            logit += update[b[:, j]]

    def sums(j, k):
        shape = (min(sizes[j], PAIR_BINS), min(sizes[k], PAIR_BINS))
        at = c[:, j] * shape[1] + c[:, k]
        p = 1 / (1 + np.exp(-logit))
        return [np.bincount(at, w, shape[0] * shape[1]).reshape(shape) for w in (y - p, p * (1 - p))]

    gains = {(j, k): _quadrants(*sums(j, k))[0] for j in range(len(sizes)) for k in range(j + 1, len(sizes))}
    chosen = sorted(gains, key=lambda jk: (-gains[jk], jk))[:PAIRS]
    model.pairs = {jk: np.zeros((min(sizes[jk[0]], PAIR_BINS), min(sizes[jk[1]], PAIR_BINS))) for jk in chosen}
    for _ in range(PAIR_ROUNDS):
        for (j, k), table in model.pairs.items():
            update = RATE * _quadrants(*sums(j, k))[1]
            table += update
            logit += update[c[:, j], c[:, k]]
    return model


def numbers_column(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(numbers(t), np.float64) for t in texts], dtype=object)
    return column(text)


def fit(docs: DataFrame, labels: DataFrame, wanted: Column, rows: int = ROWS) -> Model:
    """Learn from the texts of ``docs`` (doc_id, text) whose ``labels``
    (doc_id, quality) satisfy ``wanted``, a condition on doc_id."""
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & wanted)
    # a bounded sample: the first rows in the order of a hash
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    got = joined.select("quality", numbers_column(F.col("text")).alias("numbers")).limit(2 * rows).collect()
    got.sort(key=lambda r: (r["numbers"], r["quality"]))  # rows come in no order; sums then agree between runs
    x = np.array([r["numbers"] for r in got], np.float64).reshape(-1, len(NUMBERS))
    return boost(x, np.array([r["quality"] for r in got], np.float64))


def score(text: Column, model: Model) -> Column:
    """The probability of label 1."""
    @F.pandas_udf("double")
    def column(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([numbers(t) for t in texts], np.float64).reshape(-1, len(NUMBERS))))
    return column(text)
