"""Patched frame-of-reference token files."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import TESTDATA
from llm_cases import documents, empty, prose, rows
from tidewell.llm import queries, tokenfiles as T
from tidewell.session import scratch_path

LIBRARY = Tokenizer.from_file(queries.WORD_BPE)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=T.BLOCK))
def test_blocks_round_trip(ids):
    ids = np.array(ids, "<u4")
    assert (T.unpack_block(b"xx" + T.pack_block(ids), 2) == ids).all()


@pytest.mark.parametrize("n", [0, 1, T.BLOCK - 1, T.BLOCK, T.BLOCK + 1, 5000])
def test_bodies_round_trip_and_outliers_cost_little(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(40_000, 40_200, n).astype("<u4")
    ids[::100] = 49_407
    body, starts = T.pack(ids)
    assert (T.unpack(body, starts) == ids).all() and len(starts) == -(-n // T.BLOCK)
    assert n < 5000 or len(body) < 1.2 * n


PIECES = st.sampled_from(["a", "The", " ", "\n", "\t", "<|endoftext|>", "'s", "é", "é", "́", "日本", "\x1c", "\x85", "1", "!!", "Σ", "İ", "\r", "Ⱥ", "×", "ſ", "Ǆ", "ʰ", "zebra", "x" * 70])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=30))
def test_encoder_equals_the_library(pieces):
    text = "".join(pieces)
    got, _ = T.encoder(queries.WORD_BPE).encode(pa.array(["", text, "so"], pa.large_string()), 2)
    own = [LIBRARY.encode(t, add_special_tokens=False).ids + [2] for t in ("", text, "so")]
    assert got.tolist() == sum(own, [])


def batches(texts):
    for text in texts:
        ids, _ = T.encoder(queries.WORD_BPE).encode(pa.array([text], pa.large_string()), 2)
        assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids + [2]


def test_words_of_one_hash_are_told_apart(monkeypatch):
    T.encoder(queries.WORD_BPE).forget()
    monkeypatch.setattr(T, "word_hashes", lambda data, starts, ends, fold: (ends - starts).astype(np.uint64))
    batches(["cat dog cow", "dog", "cow it is at", "cat. dog! 12"])
    T.encoder(queries.WORD_BPE).forget()


def test_memory_is_bounded_in_bytes(monkeypatch):
    own = T.encoder(queries.WORD_BPE)
    own.forget()
    monkeypatch.setattr(T, "REMEMBERED_BYTES", 3000)
    batches([prose(i, 60) + " " + "日本語" * 400 + "x" * 500 for i in range(12)])
    assert own.spelled.nbytes + own.ids.nbytes + 24 * len(own.hashes) < 2 * 3000 and np.diff(own.spelled_at).max() <= T.LONGEST
    own.forget()


def expected(texts):
    """(id, start, n, crc32) in ascending order of (id, text), nulls first."""
    out, start = [], 0
    for key, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_given_documents(spark):
    found = queries.op8_token_files(spark, f"{TESTDATA}/sf0.001").collect()
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, found)) == expected([tuple(r) for r in docs])


def test_edges(spark, monkeypatch):
    out = scratch_path(spark, "files")
    T.write_token_files(documents(spark), queries.WORD_BPE, out)
    found = T.document_checks(T.read_runs(spark, out)).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected([r[:2] for r in rows()])
    whole = T.read_documents(T.read_runs(spark, out)).where("id = 4").first()
    assert np.frombuffer(whole["ids"], "<u4").tolist() == LIBRARY.encode("one", add_special_tokens=False).ids + [2]


def test_empty_table(spark):
    out = scratch_path(spark, "files")
    T.write_token_files(empty(spark), queries.WORD_BPE, out)
    assert T.document_checks(T.read_runs(spark, out)).count() == 0


def test_an_id_of_very_many_rows(spark):
    texts = [(7, prose(i, 5)) for i in range(300)] + [(None, prose(i, 3)) for i in range(200)] + [(i, "x") for i in range(20)]
    out = scratch_path(spark, "files")
    T.write_token_files(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), queries.WORD_BPE, out)
    runs = T.read_runs(spark, out)
    assert sorted(map(tuple, T.document_checks(runs).collect()), key=lambda r: r[1]) == expected(texts)
    assert runs.where("array_contains(ids, 7)").select("file").distinct().count() > 1
