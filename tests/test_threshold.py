"""The threshold join against the whole correlation matrix."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.operators import threshold as T
from tidewell.plans import latent
from tidewell.session import materialize


def frame(spark, vectors):
    rows = [(i * 3 + 1, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "key long, v array<double>").repartition(4)


def by_hand(vectors, limit):
    """Pairs of different vectors, each under its smallest key, with the numbers of copies."""
    first, n = {}, {}
    for i, v in enumerate(vectors):
        v = tuple(float(x) for x in v)
        if len(set(v)) > 1:
            first.setdefault(v, i * 3 + 1)
            n[v] = n.get(v, 0) + 1
    keys = list(first)
    units = np.array(keys) - np.array(keys).mean(1, keepdims=True)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    r = units @ units.T
    return {(first[a], first[b]): (r[i, j], n[a], n[b]) for i, a in enumerate(keys) for j, b in enumerate(keys)
            if first[a] < first[b] and r[i, j] >= limit}


def clusters(seed, centres, size, dims=16, noise=0.15):
    rng = np.random.default_rng(seed)
    out = (rng.standard_normal((centres, 1, dims)) + noise * rng.standard_normal((centres, size, dims))).reshape(-1, dims)
    copies = rng.integers(0, len(out), len(out) // 5)
    hot = np.repeat(out[:1], len(out) // 3, axis=0)  # a third of all rows are one vector
    return np.concatenate([out, out[copies], hot, np.ones((3, dims))])


def collected(pairs):
    rows = pairs.collect()
    assert len(rows) == len({(r["left"], r["right"]) for r in rows})
    return {(r["left"], r["right"]): (r["r"], r["n_left"], r["n_right"]) for r in rows}


def check(got, want):
    assert set(got) == set(want)
    for pair, (r, n_left, n_right) in want.items():
        assert abs(got[pair][0] - r) < 1e-9 and got[pair][1:] == (n_left, n_right)


@pytest.mark.parametrize("limit, pivots, part", [(0.9, 256, 4096), (0.9, 5, 30), (0.98, 40, 7), (0.2, 12, 50), (-0.5, 3, 4096), (0.9, 1, 25)])
def test_all_pairs(spark, monkeypatch, limit, pivots, part):
    monkeypatch.setattr(T, "PART", part)
    monkeypatch.setattr(T, "SLICE", 16)
    vectors = clusters(pivots, 12, 9)
    found = materialize(T.distinct_vectors(frame(spark, vectors), "key", F.col("v")), "vectors")
    check(collected(T.correlated_pairs(found, limit, pivots)), by_hand(vectors, limit))


def test_far_cells_are_not_visited(spark):
    vectors = clusters(4, 40, 25, dims=24, noise=0.05)
    found = materialize(T.distinct_vectors(frame(spark, vectors), "key", F.col("v")), "vectors")
    pivots = T._matrix(found.orderBy(F.xxhash64("id")).limit(200).select("unit").toArrow().column("unit"))
    placed = materialize(T._placed(found.select("unit", "id", "n"), pivots), "cells")
    reach = np.full(200, -np.inf)
    for r in placed.groupBy("cell").agg(F.max("angle").alias("reach")).collect():
        reach[r["cell"]] = r["reach"]
    visits = T._visits(placed, pivots, reach, np.arccos(0.95)).count()
    assert visits < 10 * found.count()  # of up to 199 cells each


def test_cells_cut_pairs_before_the_product():
    import pyarrow as pa

    angles = np.linspace(0, 3, 400)
    units = np.column_stack([np.cos(angles), np.sin(angles)])
    table = pa.table({"unit": pa.array(list(units)), "angle": pa.array(angles)})
    rows, others, r = T._compared(table, table, np.cos(0.1), 0.1 + 1e-6, True)
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if units[i] @ units[j] >= np.cos(0.1)}
    assert set(zip(rows.tolist(), others.tolist())) == want


def test_members_and_edges(spark):
    vectors = [[1, 2, 3], [2, 4, 6], [1, 2, 3], [5, 5, 5], [3, 2, 1], [1, 2, 3.1]]
    table = frame(spark, vectors)
    table = table.union(spark.createDataFrame([(99, None), (100, [1.0, float("nan"), 2.0])], table.schema))
    got = collected(latent.correlated_pairs(table, "key", F.col("v"), 0.9))
    assert {k: v[1:] for k, v in got.items()} in ({(1, 16): (3, 1)}, {(1, 4): (2, 1), (1, 16): (2, 1), (4, 16): (1, 1)})
    listed = {r["key"]: r["id"] for r in T.members(table, "key", F.col("v")).collect()}
    assert listed[7] == 1 and listed[13] == 13 and 10 not in listed and 99 not in listed
    assert latent.correlated_pairs(table.where("key < 0"), "key", F.col("v")).collect() == []
    with pytest.raises(ValueError):
        T.correlated_pairs(T.distinct_vectors(table, "key", F.col("v")), -1)


def test_visits_of_a_batch_are_made_in_bounded_pieces(monkeypatch):
    """Vectors that may have partners in every cell: their copies are never all in memory at once."""
    monkeypatch.setattr(T, "PART", 16)
    units = np.random.default_rng(5).standard_normal((50, 8))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    pivots = units[:20]
    angles = T._angles(units, pivots)
    cell = angles.argmin(1)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(units.tolist()), pa.array(range(50)), pa.array([1] * 50), pa.array(cell, pa.int32()), pa.array(angles.min(1))],
        ["unit", "id", "n", "cell", "angle"],
    )
    pieces = list(T._visiting(batch, pivots, np.full(20, np.pi), np.pi))
    assert max(len(piece) for piece in pieces) <= 16
    got = sorted((i, c) for piece in pieces for i, c in zip(piece.column("id").to_pylist(), piece.column("cell").to_pylist()))
    assert got == sorted((i, c) for i in range(50) for c in range(cell[i]))
