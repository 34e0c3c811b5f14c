import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewell.catalog import latent as registered
from tidewell.operators import factors, ratings as R
from tidewell.plans import collaborative, latent

K = 4


@pytest.fixture(scope="module")
def dense():
    rng = np.random.default_rng(1)
    m = (rng.standard_normal((60, 6)) * [30, 10, 5, 3, 1, 0.5]) @ rng.standard_normal((6, 35))
    m[rng.random(m.shape) < 0.5] = 0
    return np.round(m, 2)


@pytest.fixture(scope="module")
def known(spark, dense):
    u, i = np.nonzero(dense)
    return spark.createDataFrame(pd.DataFrame({"userId": u + 100, "movieId": i + 10, "rating": dense[u, i]}))


@pytest.fixture(scope="module")
def movies(spark, dense):
    rows = [(i + 10, f"movie {i:02d}", "x") for i in range(dense.shape[1])] + [(999, "never rated", "x")]
    return spark.createDataFrame(rows, "movieId long, title string, genres string")


def truth(m, k):
    _, s, v = np.linalg.svd(m, full_matrices=False)
    v = v[:k]
    return s[:k], (v * np.sign(v[np.arange(k), np.abs(v).argmax(1)])[:, None]).T


@pytest.mark.parametrize("centred", [False, True])
def test_factors_equal_dense_svd(spark, dense, known, centred):
    m = dense - dense.mean(1, keepdims=True) if centred else dense
    model = factors.item_factors(known.toDF("user", "item", "rating"), K, centred, oversampling=5)
    sigma, v = truth(m, K)
    np.testing.assert_allclose(model.sigma, sigma, rtol=1e-9)
    got = np.array([r["factor"] for r in model.items.orderBy("item").collect()])
    np.testing.assert_allclose(got, v, atol=1e-6)


def test_block_as_wide_as_the_items(spark, dense, known):
    model = factors.item_factors(known.toDF("user", "item", "rating"), K, oversampling=60)
    np.testing.assert_allclose(model.sigma, truth(dense, K)[0], rtol=1e-9)


def test_unfinished_iteration_raises(spark, known):
    with pytest.raises(factors.NotConverged, match="after 2 passes"):
        factors.item_factors(known.toDF("user", "item", "rating"), K, oversampling=2, max_passes=2)


def test_small_factors_converge_too(spark):
    """Eigenvalues over six orders of magnitude: each vector is held to its own."""
    rng = np.random.default_rng(4)
    m = rng.standard_normal((50, 20)) * 0.4 ** np.arange(20)
    rows = spark.createDataFrame(pd.DataFrame(
        {"user": np.repeat(np.arange(50), 20), "item": np.tile(np.arange(20), 50), "rating": m.ravel()}
    ))
    model = factors.item_factors(rows, 8, oversampling=4)
    sigma, _ = truth(m, 8)
    np.testing.assert_allclose(model.sigma, sigma, rtol=1e-9)
    got = np.array([r["factor"] for r in model.items.orderBy("item").collect()])
    vectors = np.linalg.svd(m)[2][:8]
    want = (vectors * np.sign(vectors[np.arange(8), np.abs(vectors).argmax(1)])[:, None]).T
    np.testing.assert_allclose(got, want, atol=1e-7)


def test_ten_decades(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((60, 24)) * 10 ** (-0.53 * np.arange(24))
    rows = spark.createDataFrame(pd.DataFrame(
        {"user": np.repeat(np.arange(60), 24), "item": np.tile(np.arange(24), 60), "rating": m.ravel()}
    ))
    model = factors.item_factors(rows, 11, oversampling=2)
    sigma, v = truth(m, 11)
    assert (sigma[-1] / sigma[0]) ** 2 < 1e-10
    np.testing.assert_allclose(model.sigma, sigma, rtol=1e-5)
    got = np.array([r["factor"] for r in model.items.orderBy("item").collect()])
    np.testing.assert_allclose(got, v, atol=1e-5)


def test_restarts_and_small_blocks(spark, monkeypatch):
    """A flat spectrum over several tiles: the basis is cut back and the residuals go on falling."""
    monkeypatch.setattr(factors, "BLOCK", 16)
    monkeypatch.setattr(factors, "BASIS_BLOCKS", 4)
    rng = np.random.default_rng(8)
    m = np.where(rng.random((70, 50)) < 0.3, rng.integers(1, 6, (70, 50)), 0).astype(float)
    m[:, 49] = 1 + np.arange(70) / 70  # one item that everybody rated
    u, i = np.nonzero(m)
    rows = spark.createDataFrame(pd.DataFrame({"user": u, "item": [f"item {x:02d}" for x in i], "rating": m[u, i]}))
    seen = []
    whole = factors._orthonormal
    monkeypatch.setattr(factors, "_orthonormal", lambda basis, scale: seen.append(basis.columns) or whole(basis, scale))
    model = factors.item_factors(rows, 3, True, oversampling=2)
    assert any(later < earlier for earlier, later in zip(seen, seen[1:])), "no restart"
    sigma, v = truth(m - m.mean(1, keepdims=True), 3)
    np.testing.assert_allclose(model.sigma, sigma, rtol=1e-9)
    got = np.array([r["factor"] for r in model.items.orderBy("item").collect()])
    np.testing.assert_allclose(got, v, atol=1e-7)


def test_too_small_a_rank_is_refused(spark):
    m = np.outer(np.arange(1, 31), np.arange(1, 21)).astype(float)
    rows = spark.createDataFrame(pd.DataFrame(
        {"user": np.repeat(np.arange(30), 20), "item": np.tile(np.arange(20), 30), "rating": m.ravel()}
    ))
    with pytest.raises(ValueError, match="rank 1"):
        factors.item_factors(rows, 3, oversampling=2)


def test_ratings_are_laid_out_once(spark, known, monkeypatch):
    """In a pass no rating is shuffled: the exchanges carry blocks of vectors and their sums only."""
    monkeypatch.setattr(factors, "BLOCK", 8)
    tiles = factors.Tiles(known.toDF("user", "item", "rating"))
    blocks = tiles.items.select("block").distinct().selectExpr("block as i", "unhex(repeat('00', 64)) as x")
    text = tiles.product(blocks, 1)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in text.split("InMemoryRelation")[0].splitlines() if "Exchange hash" in line]
    assert moved and not any("by_user" in line or "by_item" in line for line in moved)
    tiles.close()


@pytest.mark.parametrize("k", [0, 35, 100])
def test_rank_is_checked(spark, known, k):
    with pytest.raises(ValueError):
        factors.item_factors(known.toDF("user", "item", "rating"), k)


@pytest.fixture(scope="module")
def model(spark, known):
    return latent.fit_ratings(known, K)


@pytest.fixture(scope="module")
def predictions(dense):
    mean = dense.mean(1, keepdims=True)
    u, s, v = np.linalg.svd(dense - mean, full_matrices=False)
    return (u[:, :K] * s[:K]) @ v[:K] + mean


def test_predictions(spark, known, model, predictions):
    rows = latent.predict_pairs(model, known.select("userId", "movieId")).collect()
    assert len(rows) == known.count()
    for r in rows:
        assert r["prediction"] == pytest.approx(predictions[r["userId"] - 100, r["movieId"] - 10], abs=1e-6)


def test_recommendations(spark, dense, known, movies, model, predictions):
    history, recs = latent.recommend(model, known, movies, 107, 5)
    seen = [(r["rating"], r["movieId"]) for r in history.collect()]
    assert seen == sorted(seen, key=lambda p: (-p[0], p[1])) and len(seen) == np.count_nonzero(dense[7])
    unseen = [i for i in range(35) if dense[7, i] == 0]
    want = sorted(unseen, key=lambda i: -predictions[7, i])[:5]
    assert [r["movieId"] - 10 for r in recs.collect()] == want


def test_whole_prediction_rows(spark, model, predictions):
    asked = spark.createDataFrame([(100,), (130,), (5,)], "userId long")
    rows = latent.predict_users(model, asked).collect()
    got = {(r["userId"] - 100, r["movieId"] - 10): r["prediction"] for r in rows}
    assert set(got) == {(u, i) for u in (0, 30) for i in range(35)}
    assert all(abs(p - predictions[at]) < 1e-6 for at, p in got.items())


def test_unknown_user_gets_no_predictions(spark, model):
    assert latent.predict_user(model, 5).isEmpty()


@pytest.mark.parametrize("tile", [2048, 7])
def test_best_unseen_of_many_users(spark, dense, known, model, predictions, monkeypatch, tile):
    monkeypatch.setattr(latent, "TILE", tile)
    everyone = known.select("userId").distinct()
    rows = latent.top_unseen(model, known, everyone, 4).collect()
    for u in range(60):
        unseen = [i for i in range(35) if dense[u, i] == 0]
        want = sorted(unseen, key=lambda i: (-round(predictions[u, i], 6), i))[:4]
        got = sorted((r["rank"], r["movieId"] - 10) for r in rows if r["userId"] == u + 100)
        assert [i for _, i in got] == want


@pytest.mark.parametrize("scale", [1, 1e12])
def test_first_columns_with_ties(scale):
    steps = np.random.default_rng(2).integers(-3, 4, (40, 30)) * float(scale)
    steps[3, 5:] = -np.inf
    for n in (1, 4, 30):
        for row, found in zip(steps, latent._first(steps, n).tolist()):
            want = sorted(range(30), key=lambda i: (-row[i], i))[:n]
            assert [i for i in found if np.isfinite(row[i])] == [i for i in want if np.isfinite(row[i])]


def test_unknown_title_is_an_error(spark, known, movies):
    fitted = latent.title_factors(collaborative.rated_movies(known, movies), K)
    with pytest.raises(KeyError):
        latent.correlated_items(fitted, "no such title")


def test_repeated_pairs_are_refused(spark, known):
    with pytest.raises(Exception, match="repeated pair 100 "):
        latent.fit_ratings(known.unionByName(known.where("userId = 100")), K)


def test_correlated_titles(spark, dense, known, movies):
    rated = collaborative.rated_movies(known, movies)
    fitted = latent.title_factors(rated, K)
    sigma, v = truth(dense, K)
    corr = np.corrcoef(v * sigma)
    got = [r["title"] for r in latent.correlated_items(fitted, "movie 03", 0.6, 50).collect()]
    assert got == [f"movie {i:02d}" for i in range(35) if corr[3, i] >= 0.6] and "movie 03" in got
    corner = latent.correlation_corner(fitted.embeddings(), "item", F.col("vector"), 8).collect()
    assert len(corner) == 36
    for r in corner:
        assert r["r"] == pytest.approx(corr[int(r["left"][-2:]), int(r["right"][-2:])], abs=1e-6)


def test_vectors_without_spread_have_no_correlation(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 3.0]), (3, [2.0, 1.0])], "id int, v array<double>")
    rows = latent.correlations_with(df, "id", F.col("v"), 1).collect()
    assert {r["id"]: r["r"] and round(r["r"], 6) for r in rows} == {1: 1.0, 2: None, 3: -1.0}


def test_rating_matrices(spark):
    df = spark.createDataFrame([(1, "a", 4.0), (1, "a", 2.0), (1, "b", 5.0), (2, "b", 1.0)], "u int, i string, rating double")
    means = {(r["u"], r["i"]): r["rating"] for r in R.mean_matrix(df, "u", "i").collect()}
    assert means == {(1, "a"): 3.0, (1, "b"): 5.0, (2, "b"): 1.0}
    assert [tuple(r) for r in R.repeated_pairs(df, "u", "i").collect()] == [(1, "a", 2)]
    wide = R.wide_matrix(df, "u", "i", ["a", "b"]).orderBy("u").collect()
    assert [tuple(r) for r in wide] == [(1, 3.0, 5.0), (2, 0.0, 1.0)]
    assert {r["u"]: r["mean_rating"] for r in R.zero_filled_means(df, "u", "i").collect()} == {1: 5.5, 2: 0.5}


def test_similar_items(spark, dense, known, movies):
    rated = collaborative.rated_movies(known, movies)
    rows = collaborative.similar_items(rated, "movie 04", 6).collect()
    unit = dense.T / np.linalg.norm(dense.T, axis=1, keepdims=True)
    sims = np.round(unit @ unit[4], 6)
    want = [4] + [i for i in sorted(range(35), key=lambda i: (-sims[i], i)) if i != 4][:5]
    assert [r["title"] for r in rows] == [f"movie {i:02d}" for i in want]
    with pytest.raises(KeyError):
        collaborative.similar_items(rated, "no such movie")


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Tables of 40 users and 30 products under 5 names, some rated twice by one user; and the dense mean ratings."""
    rng = np.random.default_rng(11)
    folder, lines = str(tmp_path_factory.mktemp("shop")), []
    for user in range(20, 60):
        lines += [(user, int(p) + 1, float(rng.integers(1, 50))) for p in rng.choice(30, 9)]
    lines += [(20, p + 1, 7.0) for p in range(20)]
    tables = {
        "orders": ([(u, u) for u in range(20, 60)], "o_orderkey long, o_custkey long"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_quantity double"),
        "part": ([(p + 1, f"name {p % 5}", "t", "b") for p in range(30)], "p_partkey long, p_name string, p_type string, p_brand string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    total, n = np.zeros((40, 30)), np.zeros((40, 30))
    for user, product, rating in lines:
        total[user - 20, product - 1] += rating
        n[user - 20, product - 1] += 1
    assert (n > 1).any() and (n.sum(0) > 0).all()
    return folder, total / np.maximum(n, 1)


@pytest.fixture(scope="module")
def every_prediction(shop):
    dense = shop[1]
    mean = dense.mean(1, keepdims=True)
    u, s, v = np.linalg.svd(dense - mean, full_matrices=False)
    return (u[:, : latent.RANK] * s[: latent.RANK]) @ v[: latent.RANK] + mean


def test_registered_predictions_cover_every_product(spark, shop, every_prediction):
    """Of the users 20 to 59 one has an id divisible by 50."""
    rows = registered.svd_predictions(spark, shop[0]).collect()
    got = {(r["userId"] - 20, r["movieId"] - 1): r["prediction"] for r in rows}
    assert len(rows) == 30 and set(got) == {(30, p) for p in range(30)}
    assert all(abs(x - every_prediction[at]) < 1e-4 for at, x in got.items())


def unseen(dense, predictions, user, n):
    left = [p for p in range(dense.shape[1]) if dense[user, p] == 0]
    return sorted(left, key=lambda p: (-round(predictions[user, p], 6), p))[:n]


def test_registered_recommendations_rank_every_unseen_product(spark, shop, every_prediction):
    rows = registered.svd_recommend(spark, shop[0]).collect()
    want = unseen(shop[1], every_prediction, registered.USER - 20, 10)
    assert [r["movieId"] - 1 for r in sorted(rows, key=lambda r: (-r["prediction"], r["movieId"]))] == want
    rows = registered.svd_top_unseen(spark, shop[0]).collect()
    for user in range(40):
        got = sorted((r["rank"], r["movieId"] - 1) for r in rows if r["userId"] == user + 20)
        assert got == list(enumerate(unseen(shop[1], every_prediction, user, 3), 1))


def test_users_with_few_ratings_are_added_up_once(spark):
    """A pass moves nothing for users with few ratings; items of theirs and of busy users come out as in a dense decomposition."""
    rng = np.random.default_rng(11)
    m = np.zeros((400, 12))
    for user in range(400):
        some = rng.choice(12, 9 if user < 20 else rng.integers(1, 5), replace=False)
        m[user, some] = rng.integers(1, 6, len(some)) * 0.8**some
    u, i = np.nonzero(m)
    rows = spark.createDataFrame(pd.DataFrame({"user": u, "item": i, "rating": m[u, i]}))
    tiles = factors.Tiles(rows)
    assert tiles.users.count() == 20 and tiles.rated.keys.count() == tiles.pairs.keys.count() == 1
    tiles.close()
    for some, centred in ((rows, True), (rows.where("user >= 20"), False)):
        dense = np.zeros((400, 12))
        for r in some.collect():
            dense[r["user"], r["item"]] = r["rating"]
        sigma, v = truth(dense - centred * dense.mean(1, keepdims=True), 3)
        model = factors.item_factors(some, 3, centred, oversampling=2)
        np.testing.assert_allclose(model.sigma, sigma, rtol=1e-8)
        np.testing.assert_allclose(np.array([r["factor"] for r in model.items.orderBy("item").collect()]), v, atol=1e-6)


@pytest.mark.parametrize("items, users, ratings, times", [(20_000, 15_000, 600_000, 1), (120_000, 90_000, 3_600_000, 3), (10**6, 10**6, 10**7, 4)])
def test_sparse_tiles_are_longer(items, users, ratings, times):
    assert factors.Tiles._longer(items, users, ratings) == times


def test_a_pass_moves_vectors_to_stretches_of_users_and_back(spark, monkeypatch):
    """One shuffle to the ratings, whatever the blocks, and a few users with few ratings are not set apart; a user may be null."""
    for name, value in (("BLOCK", 8), ("STRETCH_RATINGS", 90), ("PIECE_RATINGS", 30)):
        monkeypatch.setattr(factors, name, value)
    rng = np.random.default_rng(5)
    m = np.where(rng.random((40, 30)) < 0.3, rng.integers(1, 6, (40, 30)), 0).astype(float)
    m[3] = 0
    m[3, 7] = 2.0
    u, i = np.nonzero(m)
    rows = spark.createDataFrame([(int(a) if a else None, int(b), float(m[a, b])) for a, b in zip(u, i)], "user int, item int, rating double")
    tiles = factors.Tiles(rows, 7)
    assert tiles.pairs is None and tiles.users.count() == 40 and tiles.rated.keys.count() > 4 and len(tiles.rated.slots) >= 8
    at = {(r["block"], r["place"]): r["item"] for r in tiles.items.collect()}
    x, blocks = rng.standard_normal((30, 7)), {}
    for block, place in sorted(at):
        blocks.setdefault(block, []).append(at[block, place])
    for width in (7, 3):
        sent = spark.createDataFrame([(b, bytearray(x[items, :width].tobytes())) for b, items in blocks.items()], "i int, x binary")
        product = tiles.product(sent, width)
        text = product._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
        assert sum("Exchange hash" in line for line in text.splitlines()) == 1
        parts, found = product.toArrow(), np.zeros((30, width))
        for block, items in blocks.items():
            some = parts.filter(np.asarray(parts.column("i")) == block)
            found[items] = factors._added(some, width, len(items))
        np.testing.assert_allclose(found, m.T @ (m @ x[:, :width]), atol=1e-9)
    tiles.close()


@pytest.mark.parametrize("asked", [[100, 130, 5], [5]])
def test_best_unseen_of_some_users_by_pieces(spark, dense, known, model, predictions, monkeypatch, asked):
    """A piece of movies is scored only where it may reach a user's n-th best, and no pair is moved; an unknown user gets none."""
    monkeypatch.setattr(latent, "PIECE_ITEMS", 3)
    monkeypatch.setattr(latent, "_tile_pairs", None)
    users = spark.createDataFrame([(u,) for u in asked], "userId long")
    rows = latent.top_unseen(model, known, users, 2).collect()
    want = set()
    for u in {*asked} - {5}:
        left = [i for i in range(35) if dense[u - 100, i] == 0]
        best = sorted(left, key=lambda i: (-round(predictions[u - 100, i], 6), i))[:2]
        want |= {(u, i + 10, rank) for rank, i in enumerate(best, 1)}
    assert {(r["userId"], r["movieId"], r["rank"]) for r in rows} == want


@pytest.mark.parametrize("basis", [128_000_000, 600])
def test_long_vectors_are_sent_once(spark, dense, known, monkeypatch, basis):
    """However many pieces of ratings, a pass shuffles no copy of the vectors for them; a short basis gives the same factors."""
    for name, value in (("SENT_ENTRIES", 10), ("PIECE_RATINGS", 90), ("BLOCK", 8), ("BASIS_ENTRIES", basis)):
        monkeypatch.setattr(factors, name, value)
    rows = known.toDF("user", "item", "rating")
    tiles = factors.Tiles(rows, 3)
    assert tiles.rated.keys.count() > 4
    blocks = tiles.items.groupBy("block").count().selectExpr("block as i", "unhex(repeat('00', int(24 * count))) as x")
    text = tiles.product(blocks, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    tiles.close()
    model = factors.item_factors(rows, K, True)
    sigma, v = truth(dense - dense.mean(1, keepdims=True), K)
    np.testing.assert_allclose(model.sigma, sigma, rtol=1e-9)
    np.testing.assert_allclose(np.array([r["factor"] for r in model.items.orderBy("item").collect()]), v, atol=1e-6)


def test_profiles_are_added_up_beside_the_ratings(spark, dense, known, model, monkeypatch):
    """Profiles of many ratings: no row of factors is moved for a rating, and the sums are those of a matrix product."""
    monkeypatch.setattr(factors, "PIECE_RATINGS", 50)
    monkeypatch.setattr(factors, "_sum_array", None)
    fitted = factors.item_factors(known.toDF("user", "item", "rating"), K)
    rows = factors.user_profiles(known.toDF("user", "item", "rating"), fitted).collect()
    v = np.array([r["factor"] for r in fitted.items.orderBy("item").collect()])
    got = {r["user"] - 100: r["profile"] for r in rows}
    assert len(rows) == len(got) == 60
    np.testing.assert_allclose(np.array([got[u] for u in range(60)]), dense @ v, atol=1e-9)
