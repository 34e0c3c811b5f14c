"""The corpus pipeline stage by stage."""

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import TESTDATA
from llm_cases import documents, empty
from tidewell.llm import queries, secret_spans
from test_llm_decontam import brute
from test_llm_neardup import brute_classes

SMALL = f"{TESTDATA}/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontamination", "secrets", "bpe"]


def test_given_documents_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = [tuple(r) for r in docs.collect()]
    (_, identify), (_, dedupe), (_, clean), (_, redact), (_, tokenise) = corpus_pipeline.STAGES

    known = spark.createDataFrame(identify(spark, docs, SMALL).collect(), docs.schema)
    assert {r["doc_id"] for r in known.collect()} == {r[0] for r in before if any(c.isalpha() for c in r[1] or "")}

    rows = [(r["doc_id"], r["text"]) for r in known.collect()]
    unique = spark.createDataFrame(dedupe(spark, known, SMALL).collect(), docs.schema)
    classes = brute_classes(rows)
    assert {r["doc_id"] for r in unique.collect()} == {i for (i, _), c in zip(rows, classes) if c is None or c == i}

    rows = [(r["doc_id"], r["text"]) for r in unique.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, _, _ in brute(rows, items)}
    kept = spark.createDataFrame(clean(spark, unique, SMALL).collect(), docs.schema)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows if i not in leaked}

    hidden = redact(spark, kept, SMALL)
    assert hidden.columns == docs.columns
    safe = {r["doc_id"]: r["text"] for r in hidden.collect()}
    for r in kept.collect():
        spans = secret_spans.base_spans(r["text"])
        assert (safe[r["doc_id"]] == r["text"]) or "<SECRET>" in safe[r["doc_id"]]
        assert all(r["text"][s:e] not in safe[r["doc_id"]] for s, _, e in spans)

    library = Tokenizer.from_file(queries.BYTE_BPE)
    for r in tokenise(spark, hidden, SMALL).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode(safe[r["doc_id"]], add_special_tokens=False).ids


def test_edges(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
    ids = sorted(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect() if r["doc_id"] is not None)
    assert ids == [4, 5, 6, 7, 10, 13, 15, 16]


def test_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SMALL).count() == 0
