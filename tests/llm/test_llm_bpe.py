"""Byte-pair encoding by last-token states against the tokenizers library."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from conftest import TESTDATA
from llm_cases import documents, empty, rows
from tidewell.llm import bpe, queries

LIBRARY = Tokenizer.from_file(queries.BYTE_BPE)
CODEC = bpe.codec(queries.BYTE_BPE)
PIECES = st.sampled_from([
    "a", "the", " ", "  ", "\n", "\t", "<|endoftext|>", "<|end", "'s", "'ll", "é", "日本", " ", "\x1c", "\x85", "　", "1",
    "23", ".", "!!", "🙂", "ing", "aaaa", "\x00", "ſ", "İ", "ª", "é", "\r\n",
])


def equal(text):
    ids = np.frombuffer(CODEC.encode_batch([text])[0], "<u4")
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert CODEC.decode(ids) == LIBRARY.decode(want, skip_special_tokens=False)


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=30))
def test_equals_the_library(pieces):
    equal("".join(pieces))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_equals_the_library_on_any_text(text):
    equal(text)


def test_words_of_one_batch_share_their_prefixes():
    words = sorted({w.encode() for w in ("the then thence there thereby thereafter th t aaaaaaaaaaaaaaaaa aaaa".split())})
    for word, ids in zip(words, CODEC.encode_words(words)):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(word.decode(), add_special_tokens=False).ids


def test_forgotten_words_are_learned_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    for text in ("one two three four", "five six seven eight nine ten", "one two", ""):
        equal(text)


def test_what_is_kept_is_bounded_in_bytes(monkeypatch):
    own = bpe.Codec(queries.BYTE_BPE)
    monkeypatch.setattr(bpe, "REMEMBERED", 100_000)
    for i in range(60):
        own.encode_batch([" ".join(f"w{i}x{j}" for j in range(100)) + " " + "长" * 5000 + str(i)])
        assert own.held + bpe.PAIR_BYTES * len(own.fits) < 200_000 and max(map(len, own.known)) <= bpe.LONGEST
        assert own.held == sum(bpe.WORD_BYTES + len(w) + len(ids) for w, ids in own.known.items())
    own.forget()
    assert not own.known and not own.fits and not own.held


def test_tasks_keep_nothing(spark):
    bpe.encode_digests(spark.createDataFrame([(1, "some words")], "doc_id long, text string"), queries.BYTE_BPE).collect()

    def held(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"n": [len(bpe.codec(queries.BYTE_BPE).known)]})

    assert [r["n"] for r in spark.range(1).coalesce(1).mapInArrow(held, "n long").collect()] == [0]


def test_ids_that_are_no_text():
    assert CODEC.decode(np.array([], np.uint32)) == ""
    half = LIBRARY.encode("🙂", add_special_tokens=False).ids[:1]
    assert CODEC.decode(np.array(half)) == LIBRARY.decode(half)


def test_given_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()}
    found = queries.op7_bpe(spark, f"{TESTDATA}/sf0.001").collect()
    assert len(found) == len(texts)
    for r in found:
        ids = LIBRARY.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges(spark):
    found = bpe.encode(documents(spark), queries.BYTE_BPE).collect()
    want = sorted((r[0] is None, r[0] or 0, r[1] or "") for r in rows())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["decoded"]) for r in found) == want
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in found)
    assert bpe.encode(empty(spark), queries.BYTE_BPE).count() == 0


def test_a_missing_file_fails():
    with pytest.raises(FileNotFoundError):
        bpe.Codec("/nowhere.json")
