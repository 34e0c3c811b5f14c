"""Spelling variants against comparing every two words, and the vocabulary against a plain count."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest import TESTDATA
from llm_cases import documents, empty, rows
from tidewell.llm import variants

FOLD = str.maketrans(variants.UPPER, variants.LOWER)


def counted(pairs):
    n = Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def near(a, b):
    """Exactly one inserted, deleted or replaced code point, by cutting the common ends."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:]


def by_hand(n):
    """Compares the words of like length that share a deletion, which near words do."""
    table = {}
    for w in n:
        for cut in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            table.setdefault(cut, set()).add(w)
    links = {w: set() for w in n}
    for group in table.values():
        for a in group:
            links[a] |= {b for b in group if near(a, b)}
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n[w], len(links[w]), n[form[w]] if form[w] else -1) for w in n)


def collected(df):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], -1 if r["form_n"] is None else r["form_n"]) for r in df.collect())


def words(seed, size, letters="abé"):
    rng = random.Random(seed)
    out = set()
    while len(out) < size:
        out.add("".join(rng.choice(letters) for _ in range(rng.randrange(6, 11))))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_both_directions_find_every_pair_once(seed):
    some = words(seed, 300, "ab" if seed % 2 else "abcé")
    own = np.ones(len(some), bool)
    if seed > 3:
        own[::3] = False
    found = [pair for side in (True, False) for pair in zip(*(x.tolist() for x in variants.search_block(some, own, side)))]
    want = {(i, j) for i, a in enumerate(some) for j, b in enumerate(some) if own[j] and near(a, b)}
    assert len(found) == len(set(found)) and set(found) == want


def test_wide_intervals_try_symbols():
    some = sorted({f"common{a}{b}" for a in "abcdefgh" for b in "abcdefgh"} | {f"{a}{b}ending" for a in "abcdefgh" for b in "abcdefgh"})
    found = [pair for side in (True, False) for pair in zip(*(x.tolist() for x in variants.search_block(some, np.ones(len(some), bool), side)))]
    assert sorted(found) == [(i, j) for i, a in enumerate(some) for j, b in enumerate(some) if near(a, b)]


@pytest.mark.parametrize("block_words", [1 << 15, 40])
def test_variants_of_a_vocabulary(spark, block_words):
    """At 40 words a block, frequent beginnings are cut into several blocks."""
    rng = random.Random(9)
    n = {w: rng.choice([2, 3, 25, 400, 5000, 10**6]) for w in words(3, 700, "abcd")}
    vocabulary = spark.createDataFrame(list(n.items()), "word string, n long")
    assert collected(variants.variants(vocabulary, block_words=block_words)) == by_hand(n)


def test_chains_of_forms(spark):
    n = {"aaaaaaa" + "b" * i: 10**i for i in range(1, 9)}
    vocabulary = spark.createDataFrame(list(n.items()), "word string, n long")
    found = collected(variants.variants(vocabulary))
    assert found == by_hand(n) and {r[2] for r in found} == {"aaaaaaa" + "b" * 8}


def test_vocabulary_of_the_odd_documents(spark):
    more = [(i, "Überraschung überraschung ÜBERRASCHUNG ×÷×÷×÷× abcdefg hijklmn_opqrstu") for i in range(70)] + [(None, "nullkey nullkey")]
    docs = documents(spark).select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = {r["word"]: r["n"] for r in variants.vocabulary(docs).collect()}
    assert got == counted([r[:2] for r in rows()] + more)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    n = counted([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert collected(variants.variants(variants.vocabulary(docs))) == by_hand(n)


def test_very_long_words():
    some = sorted(["abcdefg" * 9000, "abcdefg" * 9000 + "x", "abcdefg" * 4500 + "x" + "abcdefg" * 4500, *words(8, 200)])
    found = [pair for side in (True, False) for pair in zip(*(x.tolist() for x in variants.search_block(some, np.ones(len(some), bool), side)))]
    assert sorted(found) == [(i, j) for i, a in enumerate(some) for j, b in enumerate(some) if near(a, b)]


def test_no_words(spark):
    assert variants.variants(variants.vocabulary(empty(spark))).collect() == []
    lone = spark.createDataFrame([("singular", 5)], "word string, n long")
    assert collected(variants.variants(lone)) == [("singular", "", "singular", 5, 0, -1)]
