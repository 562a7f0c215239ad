"""Fingerprints: exact shingles, likeness near the Jaccard similarity, the
neighbours against brute force."""

import hashlib
import random

import numpy as np
import pytest

from aisle.llm import fingerprint as fp
from aisle.llm import queries, shingles


def true_shingles(text):
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_shingles_are_those_of_brute_force(monkeypatch):
    rnd = random.Random(3)
    for n in (0, 1, 2, 4, 5, 6, 30, 700):
        texts = [rnd.choice(["", " ", "\n"]) + rnd.choice(" \t\n").join(rnd.choice("aé b c d😀") * rnd.randint(1, 3) for _ in range(n)) for _ in range(6)]
        for a in texts:
            for b in texts:
                x, y = shingles.shingles(a), shingles.shingles(b)
                s, t = true_shingles(a), true_shingles(b)
                assert len(x) == len(s)
                assert len(np.intersect1d(x, y)) == len(s & t)
    text = " ".join(str(rnd.randint(0, 5000)) for _ in range(20_000))
    whole = shingles.shingles(text)
    monkeypatch.setattr(shingles, "STRETCH", 1000)
    assert (shingles.shingles(text) == whole).all() and len(whole) == len(true_shingles(text))


@pytest.mark.parametrize("n", [3, 20, 200, 3000])
def test_likeness_is_near_jaccard(n):
    rnd = random.Random(n)
    errors = []
    for _ in range(60):
        words = [str(rnd.random()) for _ in range(n)]
        other = list(words)
        for k in range(rnd.randint(0, max(1, n // 20))):
            other[rnd.randrange(n)] = "x"
        a, b = " ".join(words), " ".join(other)
        errors.append(fp.likeness_of(fp.bins(a), fp.bins(b)) - jaccard(true_shingles(a), true_shingles(b)))
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < (0.06 if n > 50 else 0.2)


def test_empty_and_equal():
    assert fp.pack(fp.bins(None)) == fp.pack(fp.bins(" \n")) == ""
    assert fp.likeness_of(None, None) == 1.0 and fp.likeness_of(None, fp.bins("a")) == 0.0
    v = fp.bins("one two three four five six")
    assert (fp.unpack(fp.pack(v)) == v).all() and fp.likeness_of(v, v) == 1.0


def check(rows, got):
    docs = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, e, n = fp.bins(text), fp.bins(edited), fp.bins(after)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.pack(a), fp.pack(e),
                     fp.likeness_of(a, e), fp.likeness_of(a, n)))
    order = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)


@pytest.mark.parametrize("rows", [
    [], [(5, "alone with a few words")], [(2, None), (1, ""), (3, "é b c d e f g")],
    [(i % 7, f"w{i} b c d e f {i} " * (i % 5)) for i in range(60)] + [(None, "n u l l i d"), (None, "m")],
    [(1 << 60 | i, f"t{i}") for i in range(50)]])
def test_neighbours(spark, rows):
    df = spark.createDataFrame([(t, "s", i) for i, t in rows], "text string, head string, doc_id long")
    check(rows, fp.with_next(df, fp.compare, fp.COMPARED).collect())


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    check([tuple(r) for r in rows], queries.op4_fingerprint(spark, sf_dir).collect())


def test_columns(spark):
    df = spark.createDataFrame([("a b c d e f", None)], "x string, y string")
    row = df.select(fp.fingerprint(df.x).alias("f"), fp.fingerprint(df.y).alias("g")).select(
        "f", "g", fp.likeness("f", "f").alias("same"), fp.likeness("f", "g").alias("other")).first()
    assert (row["f"], row["g"], row["same"], row["other"]) == (fp.pack(fp.bins("a b c d e f")), "", 1.0, 0.0)
