"""Byte convolutional language identification."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from llm_cases import documents, empty
from tidewell.llm import language, queries
from tidewell.llm.arrays import flat

TOY = {"aa": "abra kadabra anna banana ", "zz": "zuzu zyzzy quiz buzz fuzzy "}


@pytest.fixture(scope="module")
def network():
    return language.train([v * 20 for v in TOY.values()] * 20, list(TOY) * 20)


def test_windows_cover_every_byte_once():
    texts = pa.array(["", "a" * 5, "b" * 128, "c" * 300], pa.large_string())
    windows, owner, filled = language.cut_windows(*flat(texts))
    assert owner.tolist() == [1, 2, 3, 3, 3] and filled.tolist() == [5, 128, 128, 128, 44]
    assert (windows[0] == [97] * 5 + [0] * 123).all() and (windows[4][44:] == 0).all()


def test_probabilities_equal_a_plain_convolution(network):
    windows, _, _ = language.cut_windows(*flat(pa.array(["the quick zebra", "x" * 200], pa.large_string())))
    for window, got in zip(windows, network.probabilities(windows)):
        embedded = network.embed[window]
        best = np.full(network.filters.shape[1], -np.inf)
        for place in range(language.WINDOW - language.WIDTHS[-1] + 1):
            best = np.maximum(best, embedded[place : place + language.WIDTHS[-1]].ravel() @ network.filters)
        logits = np.maximum(best + network.bias, 0) @ network.dense + network.out
        assert np.allclose(got, np.exp(logits) / np.exp(logits).sum(), atol=1e-4)


def test_held_out_accuracy(spark):
    found = queries.op1_language_id(spark, f"{TESTDATA}/sf0.01")
    truth = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(truth.where("lang is not null"), "doc_id")
    right, total = rows.agg(F.sum((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert total > 200 and right / total >= 0.95


def test_edges(spark, network):
    found = language.predict(documents(spark), network, ["doc_id"]).collect()
    assert len(found) == 18
    by_id = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    assert [by_id[i] for i in (1, 2, 3, 12)] == [("und", 0.0)] * 4
    assert by_id[6][0] in TOY and 0 <= by_id[6][1] <= 1
    assert len({(r["lang_pred"], r["score"]) for r in found if r["doc_id"] in (7, 8, 14)}) == 1


def test_empty_table_and_nothing_to_learn_from(spark):
    assert language.fit(empty(spark)) is None
    assert language.predict(empty(spark), None, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in language.predict(documents(spark), None, ["doc_id"]).collect()} == {"und"}


def test_rejected_rows_go_and_columns_stay(spark, network):
    docs = documents(spark)
    kept = language.keep_identified(docs, network)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()}.isdisjoint({1, 2, 3, 12})
    assert kept.where("doc_id = 8").first()["lang"] in TOY


def test_sample_is_bounded_and_learns_only_from_the_fold(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('abc ', 30) as text", "'en' as lang")
    fold = docs.where(language.learn_fold()).count()
    assert 1500 < fold < 2500
    assert language.fit(docs, per_language=5, learn=language.learn_fold()).languages == ["en"]
