"""BPE against the tokenizers library, and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aisle.llm import bpe, queries

ODD = [" ", "  ", "\n", "\t", "\r", "a", "bc", "the", "'s", "'ll", "1", "²", "½", "一", "\x1c", "\x85", "\xa0", " ", "é", "ß", "😀",
       "<|endoftext|>", "<|endof", ".", "!!", "_", "́", "Ⅷ", "٣", "​", "\x00", "　", " word", " word,", "\nWord"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BYTE_BPE)


def test_odd_texts(library, monkeypatch):
    encoder = bpe.Encoder(queries.BYTE_BPE)
    encoder.later.most = encoder.pieces.most = 10_000  # caches that overflow
    rnd = random.Random(1)
    for _ in range(5000):
        text = "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14)))
        ids = encoder.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)
        assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_long_texts_and_broken_utf8(library):
    encoder = bpe.Encoder(queries.BYTE_BPE)
    for text in ("ab" * 50_000, "word " * 50_000, "一二三" * 20_000):
        ids = encoder.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert encoder.decode(ids) == text
    half = np.array(library.encode("😀").ids[:1], "<u4").tobytes()
    assert encoder.decode(half) == library.decode(library.encode("😀").ids[:1], skip_special_tokens=False)


def test_columns_keep_the_row(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "a b", "x"), (2, "a b", "x")], "doc_id int, text string, ids string")
    out = df.select("*", bpe.encode_column(F.col("text"), queries.BYTE_BPE).alias("tokens"))
    rows = out.select("*", bpe.decode_column(F.col("tokens"), queries.BYTE_BPE).alias("back"), bpe.n_tokens(F.col("tokens")).alias("n")).collect()
    assert [(r["ids"], r["back"], r["n"]) for r in rows] == [("x", "", 0), ("x", "", 0), ("x", "a b", 2), ("x", "a b", 2)]
    assert df.limit(0).select(bpe.encode_column(F.col("text"), queries.BYTE_BPE)).collect() == []


def test_caches_are_bounded_in_bytes(library):
    encoder = bpe.Encoder(queries.BYTE_BPE)
    encoder.later.most = 200_000
    rnd = random.Random(4)
    for _ in range(300):
        text = " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(1, 60))) for _ in range(20))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        held = sum(bpe.ENTRY_BYTES + len(k) + len(v) for k, v in encoder.later.items())
        assert held <= 200_000 and max(map(len, encoder.later), default=0) <= bpe.CACHE_CHARS


def test_round_trip_encodes_once(spark):
    df = spark.createDataFrame([(1, None), (2, "a b"), (3, "")], "doc_id int, text string")
    rows = df.select("doc_id", bpe.round_trip_column(F.col("text"), queries.BYTE_BPE).alias("r")).select("doc_id", "r.*").collect()
    assert [(r["doc_id"], len(r["ids"]), r["decoded"]) for r in rows] == [(1, 0, ""), (2, 8, "a b"), (3, 0, "")]
    assert df.limit(0).select(bpe.round_trip_column(F.col("text"), queries.BYTE_BPE)).collect() == []


def test_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op1_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids, "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
