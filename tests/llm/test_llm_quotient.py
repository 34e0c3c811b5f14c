"""Exact duplicates against a dictionary of normalised texts; filters against counting."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_cases import documents, empty, rows
from tidewell.llm import quotient


def by_hand(rows):
    """(id, keep_id, size, sha) of all rows, and how many rows stay per text."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str), len(groups)


def compare(found, rows):
    got = [tuple(r) for r in found.collect()]
    want, groups = by_hand(rows)
    assert sorted(((i, keep, n, sha) for i, keep, n, _, sha in got), key=str) == want
    stay = [r for r in got if r[3]]
    assert len(stay) == groups == len({r[4] for r in stay}) and all(r[0] == r[1] for r in stay)


@pytest.mark.parametrize("bits", [64, 63, 33, 24, 9])
@pytest.mark.parametrize("n", [0, 1, 7, 3000])
def test_filter_lists_what_was_counted(bits, n):
    rng = np.random.default_rng(n + bits)
    values = rng.integers(0, 1 << bits, n, dtype=np.uint64) if bits < 64 else rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
    values = np.concatenate([values, values[:2], np.repeat(values[:1], 70_000)])
    every, counts = np.unique(values, return_counts=True)
    got = quotient.listed(quotient.build(every, counts, bits))
    assert (got[0] == every).all() and (got[1] == counts).all()


def test_crowded_quotients_shift_and_large_counters_need_digits():
    every = np.arange(250, 256, dtype=np.uint64)  # all homes at the end of the table
    counts = np.array([1, 2, 255, 256, 257, 1 << 40])
    got = quotient.listed(quotient.build(every, counts, 8))
    assert got[0].tolist() == every.tolist() and got[1].tolist() == counts.tolist()


def test_merge_loses_nothing():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 5000, size, dtype=np.uint64) << np.uint64(40) for size in (1, 100, 4000, 20_000)]
    filters = [quotient.build(*np.unique(p, return_counts=True), 64) for p in parts]
    every, counts = np.unique(np.concatenate(parts), return_counts=True)
    left, right = (quotient.listed(quotient.merged(order, 64)) for order in (filters, filters[::-1]))
    for got in (left, right):
        assert (got[0] == every).all() and (got[1] == counts).all()


def test_filters_cut_by_range_count_all_partitions(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('text ', id % 700) as text").repartition(7)
    stored = quotient._stored(docs, "doc_id", "text", 64, [])
    filters = quotient.merge_filters(quotient.partition_filters(stored, 3), 3)
    assert filters.count() == 8
    want = Counter(r["fp"] for r in stored.select("fp").collect())
    assert {r["fp"]: r["n"] for r in quotient.repeated(filters, 3).collect()} == {f: n for f, n in want.items() if n > 1}


@pytest.mark.parametrize("bits", [64, 6])
def test_groups_of_the_odd_documents(spark, bits):
    """At six bits unlike texts share fingerprints and are told apart by their bytes."""
    compare(quotient.exact_groups(documents(spark), bits=bits), [r[:2] for r in rows()])


@pytest.mark.parametrize("bits", [64, 7])
def test_hot_and_cold_groups(spark, bits):
    made = [(i, "hot  text" if i % 3 else f"t {i % 977}") for i in range(6000)] + [(None, "hot text"), (5, "hot\ntext"), (None, "lone")]
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(5)
    compare(quotient.exact_groups(docs, bits=bits), made)


def test_no_rows(spark):
    assert quotient.exact_groups(empty(spark)).collect() == []
    assert quotient.drop_copies(empty(spark)).collect() == []


def test_dropping_keeps_all_columns(spark):
    docs = documents(spark).selectExpr("*", "n_chars as `meta.x`")
    kept = quotient.drop_copies(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    want = {re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows()}
    got = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()]
    assert sorted(got) == sorted(want)


def test_string_keys(spark):
    docs = spark.createDataFrame([("b-1", "x y"), ("a-1", "x  y"), ("c", "z")], "doc_id string, text string")
    compare(quotient.exact_groups(docs), [("b-1", "x y"), ("a-1", "x  y"), ("c", "z")])


def test_filters_of_two_corpora_merge(spark):
    a = spark.range(50).selectExpr("id as doc_id", "concat('a', id) as text")
    b = spark.range(20, 90).selectExpr("id as doc_id", "concat('a', id) as text")
    both = quotient.corpus_filter(a).unionByName(quotient.corpus_filter(b))
    assert quotient.repeated(quotient.merge_filters(both, 0), 0).count() == 30
