"""Piece encoding against the sentencepiece library, and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from aisle.llm import pieces, queries

ODD = [" ", "  ", "\n", "\t", "\r", "a", "bc", "the", "1", "²", "一", "\x00", "é", "😀", "▁", "▁▁", "<s>", "<0x41>", "<unk>", ".", "!!",
       " word", " word,", "\nWord", "�", "ষ", "\x1c", "́", "\xa0", "    "]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=queries.PIECE_BPE)


def test_odd_texts(library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_BYTES", 20_000)  # a cache that overflows
    encoder = pieces.Encoder(queries.PIECE_BPE, check=True)
    assert encoder.vocabulary.cuts
    rnd = random.Random(1)
    for _ in range(5000):
        text = "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14)))
        ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert ids == library.encode(text), repr(text)
        assert ids == encoder.vocabulary.encode_normal(encoder.vocabulary.normal(text))  # without cuts
        assert encoder.vocabulary.decode(ids) == library.decode(ids), repr(text)
    assert encoder.held <= 20_000


def test_any_ids_decode(library):
    v = pieces.Vocabulary(queries.PIECE_BPE)
    rnd = random.Random(2)
    some = [0, 1, 2, 259, 260, 264, 13, 3 + 0xE4, 3 + 0xB8, 3 + 0xAD, 3 + 0x20]
    for _ in range(5000):
        ids = [rnd.choice([*some, rnd.randrange(3, 259), rnd.randrange(32_000)]) for _ in range(rnd.randint(0, 7))]
        assert v.decode(ids) == library.decode(ids), ids


def test_long_texts(library):
    encoder = pieces.Encoder(queries.PIECE_BPE, check=True)
    for text in ("ab" * 50_000, "word " * 50_000, "一二三" * 20_000, " " * 10_000, "\n" * 10_000):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text)


def test_unused_pieces_come_apart():
    v = pieces.Vocabulary(queries.PIECE_BPE)
    whole = v.symbols("▁there")
    v.unused = {whole[0]}
    assert len(whole) == 1 and "".join(v.symbols("▁there")) == "▁there" and len(v.symbols("▁there")) == 2


def test_a_difference_is_an_error():
    encoder = pieces.Encoder(queries.PIECE_BPE, check=True)
    encoder.vocabulary.rank.pop("▁there")
    with pytest.raises(RuntimeError, match="there"):
        encoder.encode(["there"])


def test_columns_keep_the_row(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "a b", "x"), (2, "a b", "x")], "doc_id int, text string, ids string")
    out = df.select("*", pieces.encode_column(F.col("text"), queries.PIECE_BPE).alias("tokens"))
    rows = out.select("*", pieces.decode_column(F.col("tokens"), queries.PIECE_BPE).alias("back")).collect()
    assert [(r["ids"], r["back"], len(r["tokens"])) for r in rows] == [("x", "", 0), ("x", "", 0), ("x", "a b", 2), ("x", "a b", 2)]
    assert df.limit(0).select(pieces.round_trip_column(F.col("text"), queries.PIECE_BPE)).collect() == []


def test_query(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op12_pieces(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_short_stretches_side_by_side():
    v = pieces.Vocabulary(queries.PIECE_BPE)
    rnd = random.Random(5)
    texts = [rnd.choice(["", "▁"]) + "".join(rnd.choice("aeiouthnsrdlABZ01.,-éß日") for _ in range(rnd.randint(1, 14))) for _ in range(3000)]
    texts += ["aaaaaaaaaaaa", "▁", "x\U000e0041", "hahahahaha"]
    found = v.encode_short(texts)
    for t in texts:
        ids = v.encode_normal(t)
        if t in found:
            assert found[t] == np.array(ids, "<u4").tobytes(), t
        else:  # a character that is no piece is written as bytes
            assert any(i in v.of_byte for i in ids), t
    assert len(found) > 2000


def test_rows_decode_as_one_by_one(library):
    v = pieces.Vocabulary(queries.PIECE_BPE)
    rows = [[], library.encode("a b\nc"), [v.bytes[0xC3]], library.encode(" 😀 é"), [], [1, *library.encode("x y")], [v.bytes[0x41]]]
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    got = v.decode_rows(np.array([i for r in rows for i in r], np.int32), ends)
    assert got == [v.decode(r) for r in rows] == [library.decode(r) for r in rows]
