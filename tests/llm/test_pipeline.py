"""The stages of the pipeline against brute force, each on its own input."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from aisle.llm.queries import BYTE_BPE
from test_joins import document_truth

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def results(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = [docs]
    for _, stage in cp.STAGES:
        import tempfile
        path = tempfile.mkdtemp() + "/stage"
        stage(spark, out[-1], "/root/testdata/sf0.01").write.parquet(path)
        out.append(spark.read.parquet(path))
    return [df.collect() for df in out]


def test_columns_and_order(results):
    assert all(list(rows[0].__fields__) == COLUMNS for rows in results[:-1] if rows)
    assert [name.split()[0] for name, _ in cp.STAGES] == ["quality", "language", "n-gram", "mixing", "BPE"]


def test_quality_stage(spark, results, sf_dir):
    kept = {r["doc_id"] for r in results[1]}
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    assert np.mean([(r["doc_id"] in kept) == (r["quality"] == 1) for r in labels]) > 0.97


def test_language_stage(results):
    kept = {r["doc_id"] for r in results[2]}
    assert all(r["doc_id"] in kept for r in results[1] if r["text"] and any(map(str.isalpha, r["text"])))


def test_join_stage(results):
    truth = document_truth([(r["doc_id"], r["text"]) for r in results[2]])
    assert sorted(r["doc_id"] for r in results[3]) == sorted(i for i, (c, _) in truth.items() if i == c)


def test_mix_stage(results):
    size = lambda t: len([w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t or "") if w])
    before, after = defaultdict(int), defaultdict(int)
    largest = defaultdict(int)
    for r in results[3]:
        before[r["source"]] += size(r["text"])
        largest[r["source"]] = max(largest[r["source"]], size(r["text"]))
    for r in results[4]:
        after[r["source"]] += size(r["text"])
    sources = sorted(before)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    left, open_, target = 1.5 * sum(before.values()), set(sources), {}
    while True:  # the excess is shared again until none is above
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > 2 * before[s]}
        target |= share | {s: 2 * before[s] for s in full}
        if not full:
            break
        left -= sum(2 * before[s] for s in full)
        open_ -= full
    assert all(abs(after[s] - target[s]) <= largest[s] / 2 + 1 for s in sources)
    assert max(Counter(r["doc_id"] for r in results[4]).values()) <= 2


def test_token_stage(results):
    library = Tokenizer.from_file(BYTE_BPE)
    assert len(results[5]) == len(results[4]) and all(r["decodes"] for r in results[5])
    texts = {r["doc_id"]: r["text"] for r in results[4]}
    for r in results[5][::7]:
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids


def test_odd_rows_and_empty_tables(spark, sf_dir):
    docs = spark.createDataFrame([(None, "a text without an id", "en", None, 1, 0), (1, None, None, None, None, 0), (1, "", "en", "s", 0, 0),
                                  (2, "the same text twice, with words", "en", "s", 3, 0), (2, "the same text twice, with words", "en", "s", 3, 0),
                                  (3, "12 34 !!", "en", "s", 3, 0)],
                                 "doc_id long, text string, lang string, source string, n_chars int, quality int")
    for df in (docs, docs.limit(0)):
        for _, stage in cp.STAGES:
            out = stage(spark, df, sf_dir)
            rows = out.collect()
            if stage is cp.known_language and df is docs:
                assert {r["doc_id"] for r in rows} == {None, 2}
            if stage is cp.no_near_copies and df is docs:
                assert Counter(r["doc_id"] for r in rows) == {None: 1, 1: 1, 2: 1, 3: 1}
            if stage is not cp.tokens:
                assert out.columns == docs.columns
            if df is not docs:
                assert rows == []
