"""Benchmark passages by CGK embedding, sampling and exact edit distance."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from conftest import TESTDATA
from llm_cases import collected, documents, empty, prose
from tidewell.llm import decontam as D, queries


def words(text):
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", (text or "").lower())


def distance(item, region):
    """Plain dynamic programming: item against any stretch of region."""
    row = [0] * (len(region) + 1)
    for i, a in enumerate(item, 1):
        before, row = row, [i]
        for j, b in enumerate(region, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (a != b)))
    return min(row)


def edited(text, n, rng):
    own = text.split()
    for _ in range(n):
        at = rng.randrange(len(own))
        rng.choice([lambda: own.__setitem__(at, "zz"), lambda: own.insert(at, "yy"), lambda: own.pop(at)])()
    return " ".join(own)


def test_stretch_distance_equals_dynamic_programming():
    rng = random.Random(1)
    for _ in range(400):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        region = [rng.randrange(4) for _ in range(rng.randint(0, 14))]
        assert D.stretch_distance(item, region) == distance(item, region)


def test_walks_of_close_stretches_agree():
    rng = np.random.default_rng(2)
    a = rng.integers(1, 2**63, 40).astype(np.uint64)
    b = np.delete(a, 10)
    both = np.concatenate([a, b])
    out = D.embed(both, np.array([0, 40, 0]), np.array([40, 39, 40]), 0, 120)
    other = D.embed(rng.integers(1, 2**63, 40).astype(np.uint64), np.array([0]), np.array([40]), 0, 120)
    assert (out[0] == out[2]).all() and (out[0] == out[1]).mean() > 0.2 and (out[0][:30] == other[0][:30]).mean() == 0


def test_repetitions_follow_the_recall():
    assert D.repetitions(0.9, 0.5, 1) == 4 and D.repetitions(0.99) > D.repetitions(0.9)


def test_recall_at_the_largest_distance():
    rng = random.Random(5)
    items = [prose(i, 12 + i % 50) for i in range(120)]
    block = D.Block.of(list(range(120)), items)
    texts = [f"{prose(900 + i, 15)} {edited(t, int(block.allowed[i]), rng)} {prose(800 + i, 9)}" for i, t in enumerate(items)]
    found = {(t, i) for t, i, _ in block.find(pa.array(texts, pa.large_string()))}
    true = {(t, t) for t in range(120) if distance(words(items[t]), words(texts[t])) <= block.allowed[t]}
    assert len(true) > 100 and len(found & true) >= 0.98 * len(true)


def brute(docs, items, share=D.SHARE):
    found = []
    for doc, text in docs:
        own = words(text)
        for item, passage in items:
            pattern = words(passage)
            if len(pattern) >= D.LEAST_WORDS and len(set(pattern) & set(own)) * 5 >= len(set(pattern)):
                d = distance(pattern, own)
                if d <= int(len(pattern) * share):
                    found.append((doc, item, d))
    return found


def test_given_documents_against_brute_force(spark):
    sf = f"{TESTDATA}/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    assert collected(queries.op9_decontamination(spark, sf)) == sorted(brute(docs, items), key=lambda r: tuple((False, str(x)) for x in r))


def test_clipped_repeated_and_awkward_items(spark):
    passage = prose(77, 30)
    items = spark.createDataFrame(
        [(1, passage), (2, passage), (3, None), (None, passage), (4, "too short"), (5, ""), (6, prose(78, 6))],
        "item_id long, text string",
    )
    half = " ".join(passage.split()[3:])
    docs = spark.createDataFrame(
        [(10, f"x {passage.upper()}! y"), (11, half), (12, passage), (12, passage), (13, prose(5, 50)), (None, passage), (14, None)],
        "doc_id long, text string",
    )
    found = collected(D.find_items(docs, items))
    assert found == sorted(
        [(d, i, n) for d, n in ((10, 0), (11, 3), (12, 0), (12, 0), (None, 0)) for i in (1, 2)],
        key=lambda r: tuple((x is None, str(x)) for x in r),
    )
    assert sorted(r["doc_id"] for r in D.drop_leaks(docs, items).collect()) == [13, 14]


def split(text):
    hashes, first = D.text_words(pa.array([text], pa.large_string()))
    return len(hashes), len(set(hashes.tolist()))


@pytest.mark.parametrize("text, n", [
    ("Ünï çödé, e\u0301t\u00e9", 3), ("\u4f60\u597d\uff0c\u4e16\u754c\u3002", 4), ("\u770bHello\u3000world2024\u5e74", 4),
    ("\u0e01\u0e34\u0e19\u0e02", 4), ("\uc548\ub155 \ud558\uc138\uc694", 2), ("\u00abmot\u00bb \u2014 \u201eWort\u201c", 2),
    ("\U0001f642\U0001f643", 2), ("\U00020000\U00020001x", 3), ("\u2026\u3002\uff01", 0),
])
def test_words_of_any_script(text, n):
    assert split(text) == (n, n)


def unspaced(seed, n, low=0x4E00, size=2000):
    rng = random.Random(seed)
    return "".join(chr(low + rng.randrange(size)) for _ in range(n))


@pytest.mark.parametrize("low, size", [(0x4E00, 2000), (0x3042, 60), (0x0E01, 40)])
def test_items_in_running_text_without_spaces(low, size):
    clause = [unspaced(i, n, low, size) for i, n in enumerate((200, 30, 12, 7, 4))]
    clause[1] = clause[1][:9] + "\uff0c" + clause[1][9:] + "\u3002"
    block = D.Block.of(list(range(5)), clause)
    before, after = unspaced(90, 80, low, size), unspaced(91, 80, low, size)
    texts = [before + c + after for c in clause] + [before + after, before + clause[0][:60] + "\u7532\u4e59" + clause[0][60:] + after]
    found = {(t, i): d for t, i, d in block.find(pa.array(texts, pa.large_string()))}
    assert all(found[i, i] == 0 for i in range(5)) and found[6, 0] == 2
    if size == 2000:
        assert set(found) == {(i, i) for i in range(5)} | {(6, 0)}


def test_short_items_are_held_without_edits_only(spark):
    items = spark.createDataFrame([(1, "Quite so short!"), (2, "gulp"), (3, "..."), (4, "\u4f60\u597d")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "a quite, so SHORT b"), (2, "quite short so"), (3, "gulps ..."), (4, "one gulp"), (5, "\u554a\u4f60\u597d\u554a"),
         (6, "\u4f60\u4e0d\u597d")], "doc_id long, text string")
    assert collected(D.find_items(docs, items)) == [(1, 1, 0), (4, 2, 0), (5, 4, 0)]
    assert sorted(r["doc_id"] for r in D.drop_leaks(docs, items).collect()) == [2, 3, 6]


def test_items_are_taken_in_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(i, 20)) for i in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(i, prose(i, 20) + " end") for i in range(12)], "doc_id long, text string")
    monkeypatch.setattr(D, "BLOCK_ITEMS", 5)
    assert len(list(D.item_blocks(items))) >= 2
    assert sorted(tuple(r)[:2] for r in D.find_items(docs, items).collect()) == [(i, i) for i in range(12)]
    assert D.drop_leaks(docs, items).count() == 0


@pytest.mark.parametrize("side", ["docs", "items"])
def test_empty_tables(spark, side):
    items = spark.createDataFrame([(1, prose(1, 20))], "item_id long, text string")
    docs = documents(spark)
    if side == "docs":
        docs = empty(spark)
    else:
        items = items.limit(0)
    assert D.find_items(docs, items).count() == 0 and D.drop_leaks(docs, items).count() == docs.count()
    assert D.drop_leaks(docs, items).columns == docs.columns
