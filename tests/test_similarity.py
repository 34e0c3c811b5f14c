import numpy as np
import pandas as pd
import pytest

from tidewell.operators import similarity as S
from tidewell.session import materialize


def frame(spark, matrix):
    r, c = np.nonzero(matrix)
    rows = pd.DataFrame({"id": r, "feature": [f"f{j}" for j in c], "weight": matrix[r, c]})
    return materialize(spark.createDataFrame(rows), "vectors")


def cosine(matrix):
    length = np.sqrt((matrix**2).sum(1, keepdims=True))
    unit = np.divide(matrix, length, out=np.zeros_like(matrix), where=length > 0)
    return np.round(unit @ unit.T, 6)


def best(sims, k):
    rows = set()
    for i, line in enumerate(sims):
        order = sorted((-s, j) for j, s in enumerate(line) if j != i and s > 0)[:k]
        rows |= {(i, j, round(-s, 6), rank + 1) for rank, (s, j) in enumerate(order)}
    return rows


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(3)
    m = np.where(rng.random((90, 40)) < 0.15, rng.integers(1, 6, (90, 40)), 0).astype(float)
    m[:, 0] = 1.0  # a feature every row has
    m[5] = 3.0  # a row with every feature
    m[7] = 0.0
    return m


SETTINGS = [{}, {"tile_ids": 30}, {"tile_ids": 4}, {"tile_ids": 30, "task_rows": 40}, {"tile_ids": 4, "task_rows": 30}]


@pytest.mark.parametrize("settings", SETTINGS)
def test_top_similar(spark, matrix, settings):
    rows = S.top_similar(frame(spark, matrix), 6, **settings).collect()
    assert {(r["id"], r["neighbor"], r["sim"], r["rank"]) for r in rows} == best(cosine(matrix), 6)


@pytest.mark.parametrize("settings", SETTINGS)
def test_pair_products(spark, matrix, settings):
    rows = S.pair_products(frame(spark, matrix), **settings).collect()
    full = matrix @ matrix.T
    assert {(r["left"], r["right"]): round(r["product"], 6) for r in rows} == {
        (i, j): round(full[i, j], 6) for i in range(90) for j in range(i, 90) if full[i, j]
    }


def test_long_rows_get_tiles_of_their_own(spark, matrix):
    layout = S._layout(frame(spark, matrix), 4, 30)
    own = [r["id"] for r in layout.long_ids.collect()]
    assert 5 in own and layout.chunks[layout.hashed + own.index(5)] > 1
    assert len(layout.chunks) > S.FEW_TILES and min(layout.chunks) == 1


def test_more_long_rows_than_tiles_for_them(spark, matrix, monkeypatch):
    monkeypatch.setattr(S, "MOST_LONG_IDS", 2)
    rows = S.top_similar(frame(spark, matrix), 6, tile_ids=30, task_rows=20).collect()
    assert {(r["id"], r["neighbor"], r["sim"], r["rank"]) for r in rows} == best(cosine(matrix), 6)


def test_similar_to_one_row(spark, matrix):
    got = {r["id"]: r["sim"] for r in S.similar_to(frame(spark, matrix), 3).collect()}
    want = cosine(matrix)[3]
    assert got == {i: want[i] for i in range(90) if i != 7}
    assert got[3] == 1.0


def test_block_product_paths_agree():
    rng = np.random.default_rng(0)
    m = np.where(rng.random((50, 300)) < 0.05, rng.random((50, 300)), 0.0)
    m[:, :20] = rng.random((50, 20))
    r, c = np.nonzero(m)
    left = pd.DataFrame({"id": r, "feature": c, "weight": m[r, c]})
    right = left[left["id"] % 2 == 0]
    ids, others, product = S._multiply(left, right)
    np.testing.assert_allclose(product, (m @ m.T)[np.ix_(ids, others)], atol=1e-12)


def test_dense_rows_write_their_best_only(spark, monkeypatch):
    """However dense the rows, tiles are whole: no task writes a pair that is not among the k best of its tile pair."""
    rng = np.random.default_rng(9)
    dense = rng.random((120, 100)) + 0.1
    vectors = frame(spark, dense)
    layout = S._layout(vectors, S.TILE_IDS, 12_000)
    assert set(layout.chunks) == {1} and layout.long_ids is None
    monkeypatch.setattr(S, "_products", None)  # the way that writes out pairs is not taken
    rows = S.top_similar(vectors, 3, task_rows=12_000).collect()
    assert {(r["id"], r["neighbor"], r["sim"], r["rank"]) for r in rows} == best(cosine(dense), 3)


def test_few_long_rows_are_cut_by_feature_only(spark):
    """Ten ids with a thousand rows each: every row is sent once, not to a tile of each other id."""
    matrix = np.where(np.random.default_rng(4).random((10, 2000)) < 0.5, 1.0, 0.0)
    vectors = frame(spark, matrix)
    layout = S._layout(vectors, S.TILE_IDS, 1000)
    assert layout.long_ids is None and len(layout.chunks) == 1 and layout.chunks[0] > 1
    assert S._tiled(vectors, layout).count() == vectors.count()
    rows = S.top_similar(vectors, 4, task_rows=1000).collect()
    assert {(r["id"], r["neighbor"], r["sim"], r["rank"]) for r in rows} == best(cosine(matrix), 4)


@pytest.mark.parametrize("entries", [60, 200, 10**6])
def test_sparse_rows_travel_to_few_tiles(spark, monkeypatch, entries):
    """Many ids with few features in common: tiles hold a number of rows, not of ids, and the result is the same."""
    rng = np.random.default_rng(12)
    m = np.where(rng.random((300, 500)) < 0.008, rng.integers(1, 6, (300, 500)), 0).astype(float)
    m[:6, 0] = 1.0
    m[20:24] = m[24]  # copies
    vectors = frame(spark, m)
    monkeypatch.setattr(S, "TILE_ENTRIES", entries)
    monkeypatch.setattr(S, "SLICE_PRODUCTS", 50)
    monkeypatch.setattr(S, "_tiled", None)
    n_tiles = S._sparse_tiles(vectors, 4)
    assert n_tiles == max(8, -(-vectors.count() // entries))
    assert S._to_pairs(S.unit_rows(vectors), n_tiles, "feature").count() <= vectors.count() * min(n_tiles, 20)
    rows = S.top_similar(vectors, 3, tile_ids=4).collect()
    assert {(r["id"], r["neighbor"], r["sim"], r["rank"]) for r in rows} == best(cosine(m), 3)


def test_sparse_tiles_are_stored_once(spark, monkeypatch):
    """No row is sent to the tiles it meets: a task reads them one after the other, and holds few products at a time."""
    rng = np.random.default_rng(16)
    m = np.where(rng.random((300, 500)) < 0.008, rng.integers(1, 6, (300, 500)), 0).astype(float)
    m[20:30] = m[30]  # copies: ties between tiles
    r, c = np.nonzero(m)
    rows = [(f"id {a:03d}", f"f{b}", float(m[a, b])) for a, b in zip(r, c)] + [("id 007", None, 1.0), (None, "f1", 2.0), ("id 008", "f2", None)]
    vectors = spark.createDataFrame(rows, "id string, feature string, weight double")
    monkeypatch.setattr(S, "TILE_ENTRIES", 70)
    monkeypatch.setattr(S, "SLICE_PRODUCTS", 40)
    monkeypatch.setattr(S, "_to_pairs", None)
    limit = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    found = S.top_similar(vectors, 3, tile_ids=4).collect()
    longer = np.append(m, np.zeros((300, 1)), axis=1)
    longer[7, -1] = 1.0  # a missing feature counts for the length only
    assert {(int(x["id"][3:]), int(x["neighbor"][3:]), x["sim"], x["rank"]) for x in found} == best(cosine(longer), 3)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == limit
    monkeypatch.setattr(S, "TILE_ENTRIES", 2)  # less than the rows of an id
    assert S._sparse_tiles(vectors, 4) == 0


def test_sparse_products_of_dense_rows(monkeypatch):
    """A row whose products are more than a slice is added up in one line."""
    rng = np.random.default_rng(13)
    m = np.where(rng.random((40, 30)) < 0.5, rng.random((40, 30)), 0.0)
    monkeypatch.setattr(S, "SLICE_PRODUCTS", 37)
    r, c = np.nonzero(m)
    found = S._sparse_best((r, c, m[r, c]), (r, c, m[r, c]), 40, 5, True)
    want = {(i, j, s) for i, j, s, _ in best(np.round(m @ m.T, 6), 5)}
    assert {(i, j, round(s / 1e6, 6)) for i, j, s in zip(*(x.tolist() for x in found))} == want


def test_first_of_long_rows():
    rng = np.random.default_rng(14)
    row = np.repeat([0, 1, 2, 5], [40, 3, 70, 12])
    column, steps = np.concatenate([rng.permutation(100)[: n] for n in (40, 3, 70, 12)]), rng.integers(1, 9, 125)
    found = list(zip(*(x.tolist() for x in S._first_of_rows(row, column, steps, 3))))
    rows = list(zip(row.tolist(), column.tolist(), steps.tolist()))
    assert found == [x for r in (0, 1, 2, 5) for x in sorted((x for x in rows if x[0] == r), key=lambda x: (-x[2], x[1]))[:3]]


@pytest.mark.parametrize("k", [3, 200])
def test_many_dense_rows_travel_as_arrays(spark, monkeypatch, k):
    """A dense row is sent once to each tile, not once per feature, and tiles do not grow in number with the rows."""
    rng = np.random.default_rng(15)
    dense = rng.standard_normal((150, 10))
    dense[20:30] = dense[30]  # copies
    dense[40, 2] = dense[41, 3] = dense[7] = 0.0
    monkeypatch.setattr(S, "STRETCH_ROWS", 4)
    monkeypatch.setattr(S, "PACKED_TILES", 5)
    monkeypatch.setattr(S, "PIECE_ENTRIES", 300)
    monkeypatch.setattr(S, "_tiled", None)
    sent, to_pairs = [], S._to_pairs
    monkeypatch.setattr(S, "_to_pairs", lambda *args: sent.append(to_pairs(*args)) or sent[0])
    rows = S.top_similar(frame(spark, dense), k, tile_ids=16).collect()
    assert sent[0].count() == 149 * 5
    assert {(r["id"], r["neighbor"], r["sim"], r["rank"]) for r in rows} == best(cosine(dense), k)
