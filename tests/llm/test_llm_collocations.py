"""Collocations against plain counting of all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from llm_cases import documents, empty, rows
from tidewell.llm import collocations

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(pairs, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in pairs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                for i in range(len(words) - m + 1):
                    f[lang][tuple(words[i : i + m])] += 1
    out = []
    for lang, count in f.items():
        found = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= 80 * found[p[i : i + m]]:
                        covered.add(p[i : i + m])
        ranked = []
        for p, a in found.items():
            if p not in covered:
                score, _, l, r = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k, count[p[:k]], count[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def collected(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def corpus(seed, size):
    rng = random.Random(seed)
    words = [f"{rng.choice('abcdé')}{i}" for i in range(40)] + ["The", "of"] * 8
    fixed = ["new york city hall", "Ad hoc", "in spite of the", "x y x y x y"]
    out = []
    for _ in range(size):
        text = ""
        for _ in range(rng.randrange(1, 60)):
            text += rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words)
            text += rng.choice([" ", " ", " ", "\t ", ", ", ".\n", "\x0b", "?"])
        out.append((rng.choice(["en", "en", "fr", None]), text))
    return out


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "lang string, text string").repartition(4)


@pytest.mark.parametrize("seed", range(4))
def test_equal_parts_are_counts(seed):
    rng = np.random.default_rng(seed)
    keys = rng.integers(1, 6, (3000, 4)).astype(np.int32)
    for row, end in zip(keys, rng.integers(1, 6, 3000)):
        row[end:] = 0
    weights = rng.integers(1, 4, 3000)
    want = Counter()
    for row, weight in zip(keys.tolist(), weights.tolist()):
        for m in range(1, 5):
            if row[m - 1]:
                want[tuple(row[:m])] += weight
    for floors in ([1] * 4, [30] * 4, [1, 1, 30, 30]):
        got = {tuple(keys[r, :m].tolist()): w for m, rows_, weight in collocations.equal_parts(keys, weights, floors) for r, w in zip(rows_, weight)}
        assert got == {p: w for p, w in want.items() if w >= floors[len(p) - 1]}


@pytest.mark.parametrize("capacity, limit", [(1 << 20, 1 << 22), (200, 1 << 22), (100, 150), (100, 20), (10**6, 1)])
def test_collocations_however_they_are_routed(spark, capacity, limit):
    """Low limits deal hot beginnings out again and add up the rest."""
    pairs = corpus(1, 700)
    found = collected(collocations.collocations(frame(spark, pairs), capacity=capacity, limit=limit))
    assert found == by_hand(pairs) and len({r[0] for r in found}) == 3


def test_ties_at_the_last_rank_go_by_spelling(spark):
    pairs = [("en", f"{a} {b}, " * 30) for a, b in zip("zyxwvéutü", "123456789")] + [("fr", "a b. " * 31 + "c d. " * 29)]
    found = collected(collocations.collocations(frame(spark, pairs), top=4))
    assert found == by_hand(pairs, top=4)
    assert [r[2] for r in found if r[0] == "en"] == ["t 8", "u 7", "v 5", "w 4"] and len(found) == 5


def test_words_that_share_a_hash_are_hashed_again(spark, monkeypatch):
    def weak(words, lang, seed):
        kept = (1 << 64) - 1 if seed else 15
        return np.fromiter(((xxhash.xxh64_intdigest(lang.encode() + w, seed) & kept) | 1 for w in words), np.uint64, len(words))

    pairs = corpus(2, 300)
    monkeypatch.setattr(collocations, "_hashes", weak)
    assert collected(collocations.collocations(frame(spark, pairs))) == by_hand(pairs)


def test_many_distinct_words():
    text = " ".join(f"w{i}" for i in range(70_000)) + " w1 w2 w3 w4"
    words, number, joined = collocations._numbered(pa.array([text, "w1 w2"], pa.large_string()))
    ids, times = collocations._folded(number, joined)
    assert len(words) == 70_000 and len(number) == 70_006 and times.sum() == 70_004
    at = {w: i + 1 for i, w in enumerate(words)}
    got = {tuple(row): n for row, n in zip(ids.tolist(), times.tolist())}
    assert got[(at[b"w1"], at[b"w2"], at[b"w3"], at[b"w4"])] == 2 and got[(at[b"w1"], at[b"w2"], 0, 0)] == 1


def test_packed_pointers_are_read_again():
    rng = np.random.default_rng(3)
    for n, m in ((0, 0), (1, 1), (300, 5), (70_000, 900)):
        hashes = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
        ids = rng.integers(0, len(hashes) + 1, (m, 4)).astype(np.int32)
        counts = rng.integers(1, 70_000, m)
        every, back, times = collocations._unpack([collocations._pack(hashes, ids, counts)])
        assert (every[1:] == hashes).all() and (back == ids).all() and (times == counts).all()


def test_languages_have_their_own_buckets(spark):
    words = spark.createDataFrame([("en", 250), ("fr", 100), ("de", 60), ("es", 50), ("", 101)], "lang string, n long")
    shares = collocations._shares(words, 100)
    taken = sorted(first + i for first, n in shares.values() for i in range(n))
    assert taken == list(range(len(taken))) and {k: n for k, (_, n) in shares.items()} in ({"en": 3, "": 2}, {"en": 3, "": 3})


def test_scores_beyond_64_bits(spark):
    words = spark.createDataFrame([(1, "en", "a", 9 * 10**18), (2, "en", "b", 8 * 10**18)], "hash long, lang string, word string, n long")
    phrases = spark.createDataFrame([([1, 2], 7 * 10**18)], "p array<long>, f long")
    assert collocations._judged(words, phrases).first()["score"] == 2_000_000 * 7 * 10**18 // (17 * 10**18)


def test_odd_documents(spark):
    docs = documents(spark).unionByName(documents(spark))
    pairs = [(r[2], r[1]) for r in rows()] * 2
    assert collected(collocations.collocations(docs, least=3)) == by_hand(pairs, 3)


def test_no_rows(spark):
    assert collocations.collocations(empty(spark)).collect() == []
    assert collocations.collocations(frame(spark, [("en", None), (None, "  . "), ("fr", "a")])).collect() == []
