"""Quality and language: held-out accuracy, and texts without content."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from aisle.llm import language, quality, queries
from aisle.llm.common import remainder


def test_quality_held_out(spark, sf_dir):
    rows = queries.op5_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert np.mean([r["predicted"] == 1 for r in held if r["quality"] == 1]) > 0.97


def test_quality_pairs_matter():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, 3))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = quality.boost(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.85


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None), (3, ""), (3, " \n"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (2, 0), (9, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality.fit(docs.withColumn("score", F.lit("clash")), known, F.lit(True))
        scores = [r[0] for r in docs.select(quality.score(F.col("text"), model)).collect()]
        assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert scores == pytest.approx([1.0] * 5)
    assert docs.limit(0).select(quality.score(F.col("text"), model)).collect() == []
    assert len(quality.numbers("word " * 300_000)) == len(quality.NUMBERS)


def test_language_held_out(spark, sf_dir):
    rows = queries.op10_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    split = {r["doc_id"]: r["held_out"] for r in rows}
    import zlib
    assert all(v == (zlib.crc32(str(k).encode()) % 4 == 2) for k, v in split.items())


def test_trigrams_by_hand(monkeypatch):
    def names(text):
        keys, counts = language.trigrams(text)
        return {"".join(chr(c) if c else " " for c in (k >> 42, k >> 21 & 0x1FFFFF, k & 0x1FFFFF)): n for k, n in zip(keys.tolist(), counts.tolist())}
    assert names("Aé, b!") == {" aé": 1, "aé ": 1, " b ": 1}
    assert names("") == names("12 !!") == {}
    whole = names("the cat and the dog and the end " * 50)
    monkeypatch.setattr(language, "STRETCH", 64)
    parts = names("the cat and the dog and the end " * 50)
    assert set(whole) <= set(parts) and sum(abs(parts[k] - n) for k, n in whole.items()) < 0.2 * sum(whole.values())


def test_binding_is_a_sum_of_products(monkeypatch):
    memory = language.Memory()
    v = memory.vector("ab ab c")
    keys, counts = language.trigrams("ab ab c")
    assert (v == sum(n * memory.bind(k).astype(float) for k, n in zip(keys.tolist(), counts.tolist()))).all()
    monkeypatch.setattr(language, "KNOWN_TRIGRAMS", 5)
    small = language.Memory()
    for text in ("ab ab c", "some other words here", "ab ab c", "x"):
        assert np.allclose(small.vector(text), language.Memory().vector(text))
        assert np.allclose(small.vector(text), memory.vector(text))


def test_language_edge_cases(spark):
    docs = spark.createDataFrame([(1, "the and", "en", ""), (2, "der und", "de", ""), (3, None, "en", ""), (4, "12", None, ""), (None, "a", "en", ""), (2, "der und", "de", "")],
                                 "doc_id long, text string, lang string, lang_pred string")
    model = language.fit(docs, remainder(F.col("doc_id"), 1) == 0)
    got = docs.select(language.predict(F.col("text"), model).alias("p")).select("p.*").collect()
    assert [r["lang_pred"] for r in got] == ["en", "de", "und", "und", "en", "de"]
    none = language.fit(docs.limit(0), F.lit(True))
    assert {tuple(r[0]) for r in docs.select(language.predict(F.col("text"), none)).collect()} == {("und", 0.0)}
