"""The token store against the tokenizers library, and what its files hold."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aisle.llm import queries, token_store
from test_bpe import ODD


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BYTE_BPE)


def expected(library, rows, end=2):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_odd_texts(library, monkeypatch):
    import random
    monkeypatch.setattr(token_store, "CACHE_BYTES", 50_000)
    encoder, rnd = token_store.LibraryEncoder(queries.BYTE_BPE), random.Random(3)
    odd = [*ODD, "Größe", "naïve,", "…", "word.,", "x" * 60, "ªº", "\n", "ǅ", "中文"]
    for _ in range(400):
        texts = [" ".join("".join(rnd.choice(odd) for _ in range(rnd.randint(0, 3))) for _ in range(rnd.randint(0, 8))) for _ in range(10)]
        for t, ids in zip(texts, encoder.encode(texts, b"\x02\0\0\0")):
            assert np.frombuffer(ids, "<u4").tolist() == [*library.encode(t, add_special_tokens=False).ids, 2], repr(t)
    assert encoder.held <= 50_000


def test_query(spark, sf_dir, library):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in queries.op9_token_store(spark, sf_dir).collect()) == expected(library, rows)


@pytest.mark.parametrize("files", [1, 5])
def test_edge_cases(spark, library, tmpdir_path, files, monkeypatch):
    monkeypatch.setattr(token_store, "CACHE_BYTES", 5000)
    import random
    rnd = random.Random(files)
    rows = [(i // 2, "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 12)))) for i in range(200)]
    rows += [(None, "x"), (None, None), (300, None), (301, "word " * 20_000)]
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], "doc_id long, text string, start int, ids string")
    token_store.write_store(df, f"{tmpdir_path}/s", queries.BYTE_BPE, 2, files)
    back = token_store.read_store(spark, f"{tmpdir_path}/s")
    got = back.select("doc_id", "start", "n_tokens", token_store.ids_crc32(F.col("ids"))).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == expected(library, rows)


def test_empty_table(spark, tmpdir_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    token_store.write_store(df, f"{tmpdir_path}/s", queries.BYTE_BPE, 2)
    assert token_store.read_store(spark, f"{tmpdir_path}/s").collect() == []


def test_files_carry_the_index(spark, sf_dir, tmpdir_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    token_store.write_store(docs, f"{tmpdir_path}/s", queries.BYTE_BPE, 2, 3)
    import glob

    from pyarrow import orc
    files = sorted(glob.glob(f"{tmpdir_path}/s/tokens/*.orc"))
    assert len(files) == 3
    bounds = []
    for f in files:
        ids = orc.ORCFile(f).read(["doc_id"]).column(0).to_pylist()
        assert ids == sorted(ids)
        bounds.append((ids[0], ids[-1]))
        assert orc.ORCFile(f).row_index_stride == token_store.ROW_INDEX_STRIDE
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    one = token_store.read_store(spark, f"{tmpdir_path}/s").where("doc_id = 5")
    assert one.count() == 1
    import contextlib
    import io
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        one.explain("formatted")
    assert "EqualTo(doc_id,5)" in plan.getvalue()


def test_words_in_one_row(library, monkeypatch):
    """New words go through the model in one row and are told apart by the
    lengths of their tokens; without these, one by one."""
    encoder = token_store.LibraryEncoder(queries.BYTE_BPE)
    words = ["the", "xyzzyq", "Größe", "中文", "a", "naïve" * 30, "zzzzzz"]
    want = [np.array(library.encode(" " + w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    monkeypatch.setattr(token_store, "WORDS", 3)
    assert encoder._words(words) == want
    encoder.lengths[:] = 0
    assert encoder._words(words) == want


def test_each_stretch_once_a_slice():
    offsets, stretches, places = token_store.cut_by_space(["a b a", "", "b  a\nc"])
    assert offsets.to_pylist() == [0, 3, 4, 7]
    assert stretches == ["a", "b", "", "a\nc"] and places.to_pylist() == [0, 1, 0, 2, 1, 2, 3]
    assert token_store.join_taken(offsets, [s.encode() for s in stretches], places) == [b"aba", b"", b"ba\nc"]
    assert token_store.cut_by_space([])[1] == []
