"""Item-based collaborative filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.ratings import mean_matrix
from tidewell.operators.similarity import similar_to, top_similar
from tidewell.session import materialize


def rated_movies(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Ratings with the columns of their movie; without the rating time."""
    return ratings.drop("timestamp").join(movies, "movieId")


def rating_vectors(rated: DataFrame, item: str = "title", user: str = "userId") -> DataFrame:
    """(id, feature, weight): an item's mean rating per user."""
    return mean_matrix(rated, item, user).select(
        F.col(item).alias("id"), F.col(user).alias("feature"), F.col("rating").alias("weight")
    )


def similar_items(rated: DataFrame, title, k: int = 6, item: str = "title") -> DataFrame:
    """(item, sim) of the ``k`` most similar items, the item itself first.

    An unknown title is an error.
    """
    vectors = rating_vectors(rated, item)
    if vectors.where(F.col("id") == F.lit(title)).isEmpty():
        raise KeyError(title)
    return (
        similar_to(vectors, title)
        .orderBy(F.when(F.col("id") == F.lit(title), 0).otherwise(1), F.desc("sim"), "id")
        .limit(k)
        .select(F.col("id").alias(item), "sim")
    )


def item_neighbors(rated: DataFrame, k: int, item: str = "title") -> DataFrame:
    """(id, neighbor, sim, rank) for every item at once."""
    return top_similar(materialize(rating_vectors(rated, item), "rating-vectors"), k)
