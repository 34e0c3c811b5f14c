"""BagMinHash near duplicates against brute force."""

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from conftest import TESTDATA
from llm_cases import WORDS, collected, documents, empty, prose
from tidewell.llm import neardup
from tidewell.llm.arrays import FOLD, flat
from tidewell.llm.components import connected


def shingles(text):
    words = WORDS.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))) if words else Counter()


def alike(a, b):
    shared, total = (sum(f(a[k], b[k]) for k in a.keys() | b.keys()) for f in (min, max))
    return shared * 5 >= total * 4


def brute_classes(rows):
    """{row number: smallest id of its class} over (id, text)."""
    bags = [shingles(t) if i is not None else Counter() for i, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations([k for k, bag in enumerate(bags) if bag], 2):
        if 4 * bags[i].total() <= 5 * bags[j].total() <= 25 * bags[i].total() / 4 + 5 and alike(bags[i], bags[j]):
            root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if bags[k]:
            least[find(k)] = min(i, least.get(find(k), i))
    return [least[find(k)] if bags[k] else None for k in range(len(rows))]


def check(spark, rows):
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id")
    want = [(i, c) for (i, _), c in zip(rows, brute_classes(rows))]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_shingle_counts():
    texts = ["a b c d e f", "A b  c d E\tf", "", "x", "x x x x x x x", "a b c d e f"]
    keys, counts, n_words = neardup.shingle_counts(*flat(pa.array(texts, pa.large_string())))
    own = [dict(zip(k := keys[(keys >> np.uint64(48)) == i] & np.uint64((1 << 48) - 1), counts[(keys >> np.uint64(48)) == i]))
           for i in range(6)]
    assert own[0] == own[1] == own[5] and len(own[0]) == 2 and own[2] == {} and list(own[4].values()) == [3]
    assert n_words.tolist() == [6, 6, 0, 1, 7, 6] and FOLD[65] == 97


@pytest.mark.parametrize("top", [1, 3, 40])
def test_signatures_are_unbiased(top):
    rng = np.random.default_rng(top)
    errors = []
    for _ in range(25):
        a, b = rng.integers(0, top + 1, (2, 50))
        b = np.where(rng.random(50) < 0.6, a, b)
        keys = np.arange(50, dtype=np.uint64) + np.uint64(rng.integers(1 << 40))
        if not a.any() or not b.any():
            continue
        bags = np.concatenate([keys[a > 0], np.uint64(1 << 48) | keys[b > 0]])
        found = neardup.bag_min_hash(bags, np.concatenate([a[a > 0], b[b > 0]]), 2, 3000)
        errors.append((found[0] == found[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.006 and np.std(errors) < 0.02


def test_equal_bags_have_equal_signatures_in_any_company():
    one = neardup.shingle_counts(*flat(pa.array([prose(1, 90)], pa.large_string())))
    two = neardup.shingle_counts(*flat(pa.array([prose(7, 30), "a", prose(1, 90)], pa.large_string())))
    a = neardup.bag_min_hash(one[0], one[1], 1, 130)[0]
    b = neardup.bag_min_hash(two[0], two[1], 3, 130)[2]
    assert (a == b).all()


def test_documents_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


def test_chains_of_edits_and_hot_groups(spark):
    """A chain whose ends differ, many near copies of one text, many equal copies, and texts alike below the threshold."""
    rng = np.random.default_rng(3)
    base = prose(11, 200).split()
    rows = []
    for step in range(12):
        rows.append((100 + step, " ".join(base[: 200 - 8 * step])))
    for k in range(120):
        words = prose(12, 150).split()
        words[int(rng.integers(150))] = f"edit{k}"
        rows.append((1000 + k, " ".join(words)))
    rows += [(2000 + k, prose(13, 60)) for k in range(50)]
    for k in range(30):
        words = prose(14, 100).split()
        for at in range(0, 100, 9):
            words[at] = f"far{k}x{at}"
        rows.append((3000 + k, " ".join(words)))
    check(spark, rows)


def test_texts_that_share_an_id(spark):
    check(spark, [(1, prose(1, 40)), (1, prose(2, 40)), (2, prose(2, 40) + " x"), (3, prose(1, 40)), (None, prose(1, 40)), (4, None)])


def test_edges(spark):
    found = neardup.near_duplicates(documents(spark)).select("doc_id", "class_id").collect()
    by_id = {r["doc_id"]: r["class_id"] for r in found}
    assert len(found) == 18
    assert [by_id[i] for i in (1, 2, 3, None)] == [None] * 4
    assert [by_id[i] for i in (4, 5, 6, 7, 8, 9, 14, 10, 11, 12)] == [4, 5, 6, 7, 7, 7, 7, 10, 10, 12]
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_one_row_of_each_class_stays(spark):
    docs = documents(spark)
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 10, 12, 13, 15, 16] and ids.count(None) == 1
    assert neardup.drop_near_duplicates(empty(spark)).count() == 0


def test_unlike_texts_under_one_id_both_stay(spark):
    a, b, c = prose(31, 60), prose(32, 60), prose(33, 60)
    rows = [(1, a), (1, b), (1, a), (2, a + " x"), (3, b), (4, c), (4, c + " x"), (5, c)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = neardup.near_duplicates(docs).select("doc_id", "class_id", "label").collect()
    assert len({bytes(r["label"]) for r in found}) == 3 and {r["class_id"] for r in found} == {1, 4}
    kept = collected(neardup.drop_near_duplicates(docs))
    assert len(kept) == 3 and {(1, a), (1, b)} <= set(kept) and kept[2][0] == 4


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(60)] + [("a", "b")], "a string, b string")
    assert collected(connected(edges)) == [(f"{i:03d}", "000") for i in range(61)] + [("a", "a"), ("b", "a")]
    assert connected(edges.limit(0)).count() == 0
