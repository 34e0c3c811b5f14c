"""Content-based recommendation from text n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.scoring import weighted_rating
from tidewell.functions.text import nested_names, word_ngrams
from tidewell.operators.postings import top_rows
from tidewell.operators.similarity import similar_to_each, top_similar
from tidewell.session import materialize

DETAIL_COLUMNS = ["id", "genres", "vote_average", "vote_count", "popularity", "title", "keywords", "overview"]
TASK_LETTERS = 1_000_000


def with_score(movies: DataFrame, share: float = 0.9) -> DataFrame:
    """Movies with at least the ``share`` quantile of votes, plus their weighted rating.

    The mean rating in the formula is that of the kept movies. The exact quantile
    keeps one counter per distinct vote count, of which a total of N votes has at most
    sqrt(2 N). The movies are stored first, since they are read for the quantile, the mean and the result.
    """
    movies = materialize(movies, "movies")
    floor = movies.agg(F.percentile("vote_count", F.lit(share))).scalar()
    popular = movies.where(F.col("vote_count") >= floor)
    mean = popular.agg(F.avg("vote_average")).scalar()
    return popular.withColumn("score", weighted_rating(F.col("vote_count"), F.col("vote_average"), floor, mean))


def prepare(movies: DataFrame, share: float = 0.9, nested: tuple[str, ...] = ("genres", "keywords")) -> DataFrame:
    """Raw movie details -> scored movies with flat text columns."""
    scored = with_score(movies.select(*DETAIL_COLUMNS), share)
    return scored.withColumns({c: nested_names(F.col(c)) for c in nested})


def set_aside(movies: DataFrame, nested: tuple[str, ...] = ("genres", "keywords")) -> tuple[DataFrame, DataFrame]:
    """(rows whose nested cells can all be read, the others), as they came; null cells can be read."""
    readable = F.lit(True)
    for name in nested:
        readable &= F.col(name).isNull() | nested_names(F.col(name), "null").isNotNull()
    return movies.where(readable), movies.where(~readable)


def ngram_counts(movies: DataFrame, text: Column, longest: int = 3) -> DataFrame:
    """(id, ngram, n).

    The texts are dealt by id into as many tasks as their length asks for, so a task counts n-grams of a bounded stretch of
    text, and the n-grams are not shuffled.
    """
    texts = materialize(movies.select("id", text.alias("text")), "ngram-texts")
    length = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-length // TASK_LETTERS))
    grams = texts.repartition(n, "id").select("id", F.explode(word_ngrams(F.col("text"), 1, longest)).alias("ngram"))
    return grams.groupBy("id", "ngram").agg(F.count("*").alias("n"))


def ngram_vectors(movies: DataFrame, text: Column) -> DataFrame:
    return ngram_counts(movies, text).select("id", F.col("ngram").alias("feature"), F.col("n").cast("double").alias("weight"))


def recommend(movies: DataFrame, movie_id, text: str = "genres", top: int = 30, n: int = 10) -> DataFrame:
    """The ``n`` best scored of the ``top`` movies most similar to one, itself left out.

    The movie itself takes one of the ``top`` places. Movies without any n-gram
    have similarity zero. An unknown movie gives no rows.
    """
    return _nearest(movies, movies.where(F.col("id") == F.lit(movie_id)), text, top, n)


def recommend_by_title(movies: DataFrame, title: str, text: str = "genres", top: int = 30, n: int = 10) -> DataFrame:
    """As ``recommend``, for all movies of a title: the ``top`` nearest of each are taken together.

    A movie near to several of them counts with its best similarity. A title that no movie has gives no rows.
    """
    return _nearest(movies, movies.where(F.col("title") == F.lit(title)), text, top, n)


def _nearest(movies: DataFrame, targets: DataFrame, text: str, top: int, n: int) -> DataFrame:
    """The ``n`` best scored among the ``top`` nearest of every target, the targets left out.

    Distinct texts are compared; a text stands for its copies through their first ``top + 1`` ids, of which one may be the target.
    """
    targets = materialize(targets.select(F.col("id").alias("target")), "targets")
    members, vectors = _distinct_texts(movies, F.col(text))
    wanted = targets.distinct().join(members, F.col("target") == F.col("id")).select("target", "group")
    wanted = materialize(wanted, "target-groups")
    sims = similar_to_each(vectors, wanted.select(F.col("group").alias("target")).distinct())
    near = top_rows(sims, ["target"], [F.desc("sim"), F.col("id")], top + 1).drop("rank")
    first = top_rows(members, ["group"], [F.col("id")], top + 1).select(F.col("group").alias("neighbor"), F.col("id").alias("member"))
    offers = near.withColumnRenamed("id", "neighbor").join(first, "neighbor")
    offers = top_rows(offers, ["target"], [F.desc("sim"), F.col("member")], top + 1).select(
        F.col("target").alias("group"), F.col("member").alias("id"), "sim"
    )
    sims = materialize(wanted.join(offers, "group").select("target", "id", "sim"), "target-neighbours")
    # similarity zero fills the places that are left, smallest ids first: 2 * top ids are enough for any target
    fillers = [row["id"] for row in movies.select("id").orderBy("id").limit(2 * top).collect()]
    filled = targets.withColumn("id", F.explode(F.lit(fillers))) if fillers else sims.select("target", "id").limit(0)
    none = filled.join(sims, ["target", "id"], "left_anti").withColumn("sim", F.lit(0.0))
    itself = targets.select("target", F.col("target").alias("id"), F.lit(1.0).alias("sim"))
    others = sims.unionByName(none).where(F.col("id") != F.col("target")).unionByName(itself)
    first = F.when(F.col("id") == F.col("target"), 0).otherwise(1)
    near = top_rows(others, ["target"], [first, F.desc("sim"), F.col("id")], top)
    best = near.groupBy("id").agg(F.max("sim").alias("sim"))
    best = best.join(targets.withColumnRenamed("target", "id"), "id", "left_anti")
    return movies.join(best, "id").orderBy(F.desc("score"), "id").limit(n)


def _distinct_texts(movies: DataFrame, text: Column) -> tuple[DataFrame, DataFrame]:
    """((id, group), n-gram vectors of the groups): ids of one and the same text are a group, named after the smallest id.

    An id with several texts is a group of its own, with the n-grams of all of them.
    """
    texts = movies.select("id", F.lower(text).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    texts = materialize(texts, "content-texts")
    ids = texts.groupBy("id").agg(F.min("text").alias("text"), (F.min("text") == F.max("text")).alias("single"))
    ids = materialize(ids, "content-ids")
    single, several = ids.where("single"), ids.where("NOT single").select("id")
    groups = materialize(single.groupBy("text").agg(F.min("id").alias("group")), "content-groups")
    members = single.join(groups, "text").select("id", "group").unionByName(several.select("id", F.col("id").alias("group")))
    rows = groups.select(F.col("group").alias("id"), "text").unionByName(texts.join(several, "id", "left_semi"))
    return materialize(members, "content-members"), materialize(ngram_vectors(rows, F.col("text")), "content-vectors")


def similar_movies(movies: DataFrame, text: Column, k: int) -> DataFrame:
    """(id, neighbor, sim, rank): the ``k`` most similar other movies of each movie.

    Movies with the same text are one row of the comparison, named after their
    smallest id; its first ``k + 1`` members stand in for it, which is enough
    because ties go by id. However many copies a text has, they are not paired.
    """
    texts = movies.select("id", F.lower(text).alias("text"))
    groups = texts.groupBy("text").agg(F.min("id").alias("group"))
    members = materialize(texts.join(groups, "text").select("id", "group"), "text-members")
    vectors = materialize(ngram_vectors(groups.withColumnRenamed("group", "id"), F.col("text")), "text-vectors")
    itself = vectors.select("id").distinct().select("id", F.col("id").alias("neighbor"), F.lit(1.0).alias("sim"))
    near = top_similar(vectors, k).select("id", "neighbor", "sim").unionByName(itself)
    first = top_rows(members, ["group"], [F.col("id")], k + 1).select(F.col("group").alias("neighbor"), F.col("id").alias("member"))
    offers = top_rows(near.join(first, "neighbor"), ["id"], [F.desc("sim"), F.col("member")], k + 1).select(
        F.col("id").alias("group"), F.col("member").alias("neighbor"), "sim"
    )
    offers = materialize(offers, "text-offers")
    pairs = members.join(offers, "group").where(F.col("id") != F.col("neighbor"))
    return top_rows(pairs, ["id"], [F.desc("sim"), F.col("neighbor")], k).select("id", "neighbor", "sim", "rank")
