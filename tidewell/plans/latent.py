"""Latent-factor recommendation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.scoring import dot, standardize
from tidewell.operators import factors as fac, threshold as threshold_join
from tidewell.operators.postings import top_rows
from tidewell.operators.ratings import strict_matrix, zero_filled_means
from tidewell.operators.similarity import array_vectors, pair_products, stored_bytes, stored_values
from tidewell.session import discard, materialize, materialize_with, read_in_turn, stored_paths

RANK = 12
CORNER = 200
TILE = 2048
TASK_USERS = 40_000
PIECE_ITEMS = 4096
PREDICTION_DIGITS = 6


def correlations_with(embeddings: DataFrame, key: str, vector: Column, target) -> DataFrame:
    """(key, r): Pearson correlation of every vector with that of ``target``."""
    unit = embeddings.select(key, standardize(vector).alias("unit"))
    wanted = unit.where(F.col(key) == F.lit(target)).select(F.first("unit")).scalar()
    return unit.withColumn("target", wanted).select(key, dot(F.col("unit"), F.col("target")).alias("r"))


def correlated_items(
    model: fac.Factors, title, threshold: float = 0.9, n: int = 50
) -> DataFrame:
    """The first ``n`` titles, in title order, whose embedding correlates strongly with one's.

    Depends on the sign of each singular vector, hence on the sign rule. An unknown title is an error.
    """
    if model.items.where(F.col("item") == F.lit(title)).isEmpty():
        raise KeyError(title)
    found = correlations_with(model.embeddings(), "item", F.col("vector"), title)
    return found.where(F.col("r") >= threshold).orderBy("item").limit(n).select(F.col("item").alias("title"), "r")


def correlation_corner(embeddings: DataFrame, key: str, vector: Column, n: int = CORNER) -> DataFrame:
    """(left, right, r) among the first ``n`` keys, each pair once."""
    first = embeddings.select(key, standardize(vector).alias("unit")).orderBy(key).limit(n)
    return pair_products(materialize(array_vectors(first, key, F.col("unit")), "corner")).select(
        "left", "right", F.col("product").alias("r")
    )


def correlated_pairs(embeddings: DataFrame, key: str, vector: Column, threshold: float = 0.9) -> DataFrame:
    """(left, right, r, n_left, n_right): all pairs of different vectors that correlate at least that much, each once.

    Rows of equal vectors are listed under their smallest key; ``operators.threshold.members`` tells which.
    """
    found = materialize(threshold_join.distinct_vectors(embeddings, key, vector), "distinct-vectors")
    return threshold_join.correlated_pairs(found, threshold)


def title_factors(rated: DataFrame, k: int = RANK, **settings) -> fac.Factors:
    """Item embeddings from mean ratings per (user, title)."""
    matrix = rated.groupBy(F.col("userId").alias("user"), F.col("title").alias("item")).agg(
        F.avg("rating").alias("rating")
    )
    return fac.item_factors(materialize(matrix, "title-matrix"), k, **settings)


@dataclass
class RatingModel:
    """Everything a prediction needs, stored in the shared folder."""

    items: DataFrame
    users: DataFrame


def fit_ratings(ratings: DataFrame, k: int = RANK, strict: bool = True, **settings) -> RatingModel:
    """Factor the user x movie matrix after taking off each user's zero-filled mean.

    ``strict`` refuses repeated (user, movie) pairs; otherwise they are averaged.
    """
    if strict:
        matrix = strict_matrix(ratings, "userId", "movieId")
    else:
        matrix = ratings.groupBy("userId", "movieId").agg(F.avg("rating").alias("rating"))
    rating = F.col("rating").cast("double").alias("rating")
    matrix = materialize(
        matrix.select(F.col("userId").alias("user"), F.col("movieId").alias("item"), rating), "rating-matrix"
    )
    model = fac.item_factors(matrix, k, centred=True, **settings)
    means = zero_filled_means(matrix, "user", "item")
    users = fac.user_profiles(matrix, model).join(means, "user")
    return RatingModel(model.items, materialize(users, "user-profiles"))


def predict_pairs(model: RatingModel, pairs: DataFrame) -> DataFrame:
    """(userId, movieId) -> with the predicted rating."""
    return (
        pairs.join(model.users, pairs["userId"] == model.users["user"])
        .join(model.items, pairs["movieId"] == model.items["item"])
        .select(*pairs.columns, fac.predicted(F.col("profile"), F.col("factor"), F.col("mean_rating")).alias("prediction"))
    )


def predict_users(model: RatingModel, users: DataFrame) -> DataFrame:
    """(userId, movieId, prediction) of the users of ``users`` (userId) for every rated movie.

    Users and movies are dealt into tiles, a task scores one tile pair as a matrix product. Unknown
    users give no rows.
    """

    def every(key, left, right):
        users, items, scores = _tile_scores(left, right)
        at, of = np.indices(scores.shape)
        return pd.DataFrame({"userId": users[at.ravel()], "movieId": items[of.ravel()], "prediction": scores.ravel()})

    kinds = {f.name: f.dataType.simpleString() for f in (*model.users.schema, *model.items.schema)}
    return _tile_pairs(model, users).applyInPandas(
        every, f"userId {kinds['user']}, movieId {kinds['item']}, prediction double"
    )


def predict_user(model: RatingModel, user_id) -> DataFrame:
    """(movieId, prediction) of one user for every rated movie."""
    one = model.users.where(F.col("user") == F.lit(user_id)).select(F.col("user").alias("userId"))
    return predict_users(model, one).drop("userId")


def top_unseen(model: RatingModel, ratings: DataFrame, users: DataFrame, n: int) -> DataFrame:
    """(userId, movieId, prediction, rank): the ``n`` best movies that each user of ``users`` (userId) has not rated.

    Movies are stored in pieces, those with long factors first; a task reads them one after the other beside its users. A
    prediction is at most the lengths of profile and factor multiplied, so a piece is scored only for users whose n-th best
    it may reach. A task keeps n movies per user, and nothing is moved for pairs.
    """
    wanted = model.users.join(users.select(F.col("userId").alias("user")).distinct(), "user", "left_semi")
    wanted = wanted.where(F.col("mean_rating").isNotNull())
    n_tiles = max(1, -(-wanted.count() // TILE))
    spark, kinds = ratings.sparkSession, {f.name: f.dataType.simpleString() for f in (*model.users.schema, *model.items.schema)}
    tile = F.pmod(F.xxhash64("user"), F.lit(n_tiles)).cast("int").alias("tile")
    rated = ratings.select(F.col("userId").cast(kinds["user"]).alias("user"), F.col("movieId").cast(kinds["item"]).alias("item"))
    left = wanted.select(tile, "user", "profile", F.col("mean_rating").cast("double").alias("mean_rating")).groupBy("tile")
    right = rated.where(F.col("user").isNotNull() & F.col("item").isNotNull()).select(tile, "user", "item").groupBy("tile")
    packed = "tile int, keys binary, seen binary, bound double, numbers binary, pairs binary"
    people = materialize(left.cogroup(right).applyInArrow(_packed_users, packed), "packed-users", compression="none")
    factor = F.col("factor")
    longest = model.items.select("item", "factor").orderBy(F.desc(dot(factor, factor)))
    pieces = materialize(longest.mapInArrow(_packed_items, "keys binary, bound double, numbers binary"), "packed-items", compression="none")
    n_tasks = min(n_tiles, max(2 * spark.sparkContext.defaultParallelism, -(-n_tiles * TILE // TASK_USERS)))
    filled = {row["tile"] % n_tasks for row in people.select("tile").collect()}

    def named(own):
        for offers in own:
            if offers.items is not None:
                yield from offers.named().to_batches()

    def best(batches):
        own, met = [], False
        for batch in batches:
            blobs = {name: batch.column(name) for name in batch.schema.names}
            for j in range(len(batch)):
                row = {name: column[j] for name, column in blobs.items()}
                if row["tile"].is_valid:
                    if met:
                        yield from named(own)
                        own, met = [], False
                    own.append(_Offers({name: pa.py_buffer(row[name].as_buffer().to_pybytes()) for name in ("keys", "seen", "numbers", "pairs")}, n))
                elif not own:
                    raise RuntimeError("movies came before the task's users")
                else:
                    met = True
                    items, factors = stored_values(row["keys"].as_buffer()), np.frombuffer(row["numbers"].as_buffer())
                    for offers in own:
                        offers.meet(items, factors.reshape(len(items), -1), row["bound"].as_py())
        yield from named(own)

    def sent(people: DataFrame) -> DataFrame:
        movies = people.sparkSession.read.schema(pieces.schema).parquet(*stored_paths(pieces))
        none = F.lit(None).cast("binary")
        movies = movies.select(F.lit(None).cast("int").alias("tile"), "keys", none.alias("seen"), "bound", "numbers", none.alias("pairs"))
        return read_in_turn([[people.where(F.col("tile") % n_tasks == at), movies] for at in sorted(filled)] or [[people]])

    schema = f"userId {kinds['user']}, movieId {kinds['item']}, prediction double"
    offers = materialize_with(people, lambda people: sent(people).mapInArrow(best, schema), "offers")
    for table in (people, pieces):
        discard(table)
    return top_rows(offers, ["userId"], [F.desc("prediction"), F.col("movieId")], n)


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    """Equally long lists as a matrix; an entry that is missing is none."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _packed_users(left: pa.Table, right: pa.Table) -> pa.Table:
    """One row for a tile of users: keys, profiles and means, and the sorted numbers user * movies seen + movie of what they rated."""
    n = len(left)
    if not n:
        return pa.table({"tile": pa.array([], pa.int32()), **{x: pa.array([], pa.binary()) for x in ("keys", "seen")},
                         "bound": pa.array([], pa.float64()), **{x: pa.array([], pa.binary()) for x in ("numbers", "pairs")}})
    users, coded = left.column("user").combine_chunks(), right.column("item").combine_chunks().dictionary_encode()
    who = pc.index_in(right.column("user").combine_chunks(), value_set=users)
    known = who.is_valid().to_numpy(zero_copy_only=False)
    pairs = who.drop_null().to_numpy().astype(np.int64) * len(coded.dictionary) + coded.indices.to_numpy()[known]
    numbers = np.column_stack([_matrix(left.column("profile"), n), left.column("mean_rating").to_numpy()])
    return pa.table({
        "tile": left.column("tile").slice(0, 1), "keys": pa.array([stored_bytes(users)], pa.binary()), "seen": pa.array([stored_bytes(coded.dictionary)], pa.binary()),
        "bound": pa.array([np.inf]), "numbers": pa.array([numbers.tobytes()], pa.binary()), "pairs": pa.array([np.unique(pairs).tobytes()], pa.binary()),
    })


def _packed_items(batches):
    """Rows of up to PIECE_ITEMS movies, sorted by key, with their longest factor."""
    for batch in batches:
        for at in range(0, len(batch), PIECE_ITEMS):
            some = pa.Table.from_batches([batch.slice(at, PIECE_ITEMS)])
            some = some.take(pc.sort_indices(some.column("item")))
            factors = _matrix(some.column("factor"), len(some))
            longest = float(np.sqrt((factors * factors).sum(1).max()))
            yield pa.record_batch([pa.array([stored_bytes(some.column("item").combine_chunks())], pa.binary()), pa.array([longest]),
                                   pa.array([factors.tobytes()], pa.binary())], ["keys", "bound", "numbers"])


class _Offers:
    """The best unseen movies of a tile of users, as far as pieces of movies were met; what equals a user's n-th best stays."""

    def __init__(self, blobs: dict, n: int):
        self.users, self.seen, self.n = stored_values(blobs["keys"]), stored_values(blobs["seen"]), n
        numbers = np.frombuffer(blobs["numbers"]).reshape(len(self.users), -1)
        self.profile, self.mean, self.pairs = numbers[:, :-1], numbers[:, -1], np.frombuffer(blobs["pairs"], np.int64)
        self.length = np.sqrt((self.profile * self.profile).sum(1))
        rated = np.bincount(self.pairs // max(1, len(self.seen)), minlength=len(self.users))
        self.most = int(rated.max(initial=0))
        self.limit = np.full(len(self.users), -np.inf)
        self.row, self.steps, self.items = np.zeros(0, np.int64), np.zeros(0), None

    def meet(self, items: pa.Array, factors: np.ndarray, longest: float) -> None:
        unit = 10**PREDICTION_DIGITS
        reach = (self.length * longest * (1 + 1e-12) + self.mean) * unit + 1
        active = np.flatnonzero((reach >= self.limit) & (self.limit < np.inf))
        if not len(active):
            return
        scores = self.profile[active] @ factors.T + self.mean[active, None]
        first = not np.isfinite(self.limit[active]).all()
        if first:
            steps = np.where(np.isfinite(scores), np.rint(scores * unit), -np.inf)
            column = _first(steps, min(self.n + self.most, len(items)))
            row = np.repeat(np.arange(len(active)), column.shape[1])
            column = column.ravel()
        else:
            row, column = np.nonzero(scores >= ((self.limit[active] - 1) / unit)[:, None])
        steps = np.rint(scores[row, column] * unit)
        row = active[row]
        kept = np.isfinite(steps) & (steps >= self.limit[row])
        row, column, steps = row[kept], column[kept], steps[kept]
        code = pc.index_in(items.take(pa.array(column)), value_set=self.seen)
        pair = row * max(1, len(self.seen)) + code.fill_null(0).to_numpy()
        at = np.searchsorted(self.pairs, pair)
        rated = code.is_valid().to_numpy(zero_copy_only=False) & (np.append(self.pairs, -1)[at] == pair)
        self._add(row[~rated], steps[~rated], items.take(pa.array(column[~rated])))

    def _add(self, row: np.ndarray, steps: np.ndarray, items: pa.Array) -> None:
        if not len(row):
            return
        row, steps = np.append(self.row, row), np.append(self.steps, steps)
        items = items if self.items is None else pa.concat_arrays([self.items, items])
        order = np.lexsort((-steps, row))
        row, steps = row[order], steps[order]
        last = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row, "left") == self.n - 1)
        self.limit[row[last]] = steps[last]
        kept = steps >= self.limit[row]
        self.row, self.steps, self.items = row[kept], steps[kept], items.take(pa.array(order[kept]))

    def named(self) -> pa.Table:
        return pa.table({"userId": self.users.take(pa.array(self.row)), "movieId": self.items, "prediction": self.steps / 10.0**PREDICTION_DIGITS})


def _first(steps: np.ndarray, n: int) -> np.ndarray:
    """The columns of the n largest whole numbers of each row, ties by column."""
    width = steps.shape[1]
    if np.abs(steps, where=np.isfinite(steps), out=np.zeros_like(steps)).max() * width > 2**52:
        return np.argsort(-steps, axis=1, kind="stable")[:, :n]
    order = np.arange(width) - steps * width
    some = np.argpartition(order, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(order, some, 1), axis=1), 1)


def _tile_pairs(model: RatingModel, users: DataFrame):
    """Grouped (profiles, factors) by tile pair."""
    wanted = model.users.join(users.select(F.col("userId").alias("user")).distinct(), "user", "left_semi")
    wanted = wanted.where(F.col("mean_rating").isNotNull())

    def tiles(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n))

    n_users, n_items = (max(1, -(-side.count() // TILE)) for side in (wanted, model.items))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = wanted.select(tiles("user", n_users).alias("u"), all_of(n_items).alias("i"), "user", "profile", "mean_rating")
    right = model.items.select(all_of(n_users).alias("u"), tiles("item", n_items).alias("i"), "item", "factor")
    return left.groupBy("u", "i").cogroup(right.groupBy("u", "i"))


def _tile_scores(people: pd.DataFrame, right: pd.DataFrame):
    """(users, items, predictions) of one tile pair."""
    items = right["item"].to_numpy()
    if not len(people) or not len(items):
        return people["user"].to_numpy(), items, np.zeros((len(people), len(items)))
    scores = np.stack(people["profile"].to_numpy()) @ np.stack(right["factor"].to_numpy()).T
    return people["user"].to_numpy(), items, scores + people["mean_rating"].to_numpy()[:, None]


def user_history(ratings: DataFrame, movies: DataFrame, user_id) -> DataFrame:
    """What the user rated, best first."""
    rated = ratings.where(F.col("userId") == F.lit(user_id)).join(movies, "movieId")
    return rated.orderBy(F.desc("rating"), "movieId")


def unseen_movies(ratings: DataFrame, movies: DataFrame, user_id) -> DataFrame:
    seen = ratings.where(F.col("userId") == F.lit(user_id)).select("movieId")
    return movies.join(seen, "movieId", "left_anti")


def recommend(
    model: RatingModel, ratings: DataFrame, movies: DataFrame, user_id, n: int = 5
) -> tuple[DataFrame, DataFrame]:
    """(history, recommendations) of a user; movies nobody rated are not recommended."""
    best = (
        unseen_movies(ratings, movies, user_id)
        .join(predict_user(model, user_id), "movieId")
        .withColumn("prediction", F.round("prediction", PREDICTION_DIGITS))
        .orderBy(F.desc("prediction"), "movieId")
        .limit(n)
    )
    return user_history(ratings, movies, user_id), best
