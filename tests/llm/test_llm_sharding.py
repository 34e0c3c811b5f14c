"""Permutation-filled lookup table."""

import hashlib

import numpy as np
import pytest

from llm_cases import documents, empty
from tidewell.llm import sharding

NAMES = [f"s{i}" for i in range(7)]


def brute(shards, slots):
    """Each shard's whole order of preference, then turns."""
    orders = []
    for name in shards:
        digest = hashlib.md5(name.encode()).digest()
        offset, step = int.from_bytes(digest[:8]) % slots, int.from_bytes(digest[8:]) % (slots - 1) + 1
        orders.append([(offset + j * step) % slots for j in range(slots)])
        assert len(set(orders[-1])) == slots
    table = {}
    while len(table) < slots:
        for number, order in enumerate(orders):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = number
    return [table[s] for s in range(slots)]


def test_table_equals_brute_force():
    assert sharding.fill_table(NAMES, 251).tolist() == brute(NAMES, 251)
    assert sharding.fill_table(["x"], 2).tolist() == [0, 0]


def test_shares_are_equal_or_by_weight():
    assert np.ptp(np.bincount(sharding.fill_table(NAMES, 1009))) <= 1
    share = np.bincount(sharding.fill_table(["a", "b"], 1009, [1, 3]))
    assert abs(share[1] - 3 * share[0]) <= 4


def test_few_keys_move_when_a_shard_goes():
    many = [f"s{i}" for i in range(40)]
    before, after = sharding.fill_table(many), sharding.fill_table(many[:-1])
    moved = (before != after) & (before != 39)
    assert moved.mean() < 0.02


@pytest.mark.parametrize("bad", [([], 251, None), (["a", "a"], 251, None), (["a"], 250, None), (["a"], 251, [0]), (["a"], 1_000_033, None)])
def test_bad_arguments(bad):
    with pytest.raises(ValueError):
        sharding.fill_table(*bad)


def test_placement(spark):
    found = sharding.place(documents(spark), NAMES, slots=251).collect()
    table = sharding.fill_table(NAMES, 251)
    assert len(found) == 18
    for r in found:
        key = "\x1e" if r["doc_id"] is None else str(r["doc_id"])
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 251
        assert (r["slot"], r["shard"], r["shard_name"]) == (slot, table[slot], NAMES[table[slot]])
    assert sharding.place(empty(spark), NAMES).count() == 0


def test_a_hot_key_is_spread(spark):
    rows = spark.range(4000).selectExpr("'hot' as source", "id as doc_id")
    one = sharding.place(rows, NAMES, key="source").select("shard").distinct().count()
    many = sharding.place(rows, NAMES, key="source", spread=50, salt="doc_id")
    assert one == 1 and many.select("shard").distinct().count() == len(NAMES) and many.count() == 4000


def test_no_shuffle(spark):
    plan = sharding.place(documents(spark).coalesce(1), NAMES)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
