"""Item-based collaborative filtering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.catalog.inputs import MOVIES_SQL, RATINGS_SQL, movies, ratings, table
from tidewell.operators import ratings as ops
from tidewell.plans import collaborative as plan

TARGET = "blue bolt"
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan.rated_movies(ratings(spark, sf_dir), movies(spark, sf_dir))


def ratings_pivot_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = ops.mean_matrix(rated(spark, sf_dir), "title", "userId")
    return means.withColumn("rating", F.round("rating", 6))


def ratings_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("movieId"), F.col("p_type").alias("kind"))
    wide = ops.wide_matrix(ratings(spark, sf_dir).join(kinds, "movieId"), "userId", "kind", TYPES)
    return wide.select("userId", *[F.round(t, 6).alias(t) for t in TYPES])


def user_zero_filled_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = ops.zero_filled_means(ratings(spark, sf_dir), "userId", "movieId")
    return means.select("userId", F.round("mean_rating", 6).alias("mean_rating"))


VECTORS_SQL = """vectors AS (SELECT {item} AS id, "userId" AS feature, avg(rating) AS w
    FROM ratings JOIN movies USING ("movieId") GROUP BY ALL),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM vectors GROUP BY ALL)"""

NEIGHBORS_SQL = """SELECT * FROM (
    SELECT one AS id, two AS neighbor, sim, (row_number() OVER (PARTITION BY one ORDER BY sim DESC, two))::INT AS rank
    FROM (SELECT a.id AS one, b.id AS two, round(sum(a.w * b.w) / (any_value(x.norm) * any_value(y.norm)), 6) AS sim
          FROM vectors a JOIN vectors b USING (feature) JOIN norms x ON x.id = a.id JOIN norms y ON y.id = b.id
          WHERE a.id <> b.id GROUP BY a.id, b.id) WHERE sim > 0) WHERE rank <= {k}"""


def _vectors_sql(item: str) -> str:
    return f"WITH {RATINGS_SQL}, {MOVIES_SQL}, {VECTORS_SQL.format(item=item)}"


QUERIES = {
    "rated_movies": (rated, f'WITH {RATINGS_SQL}, {MOVIES_SQL} SELECT * FROM ratings JOIN movies USING ("movieId")'),
    "ratings_pivot_mean": (
        ratings_pivot_mean,
        f"""WITH {RATINGS_SQL}, {MOVIES_SQL} SELECT title, "userId", round(avg(rating), 6) AS rating
        FROM ratings JOIN movies USING ("movieId") GROUP BY title, "userId" """,
    ),
    "strict_pivot_duplicates": (
        lambda s, d: ops.repeated_pairs(ratings(s, d), "userId", "movieId"),
        f"""WITH {RATINGS_SQL} SELECT "userId", "movieId", count(*) AS n
        FROM ratings GROUP BY "userId", "movieId" HAVING count(*) > 1""",
    ),
    "ratings_wide": (
        ratings_wide,
        f"""WITH {RATINGS_SQL} SELECT "userId", """
        + ", ".join(f"""round(coalesce(avg(rating) FILTER (p_type = '{t}'), 0), 6) AS "{t}" """ for t in TYPES)
        + """FROM ratings JOIN part ON p_partkey = "movieId" GROUP BY "userId" """,
    ),
    "user_zero_filled_mean": (
        user_zero_filled_mean,
        f"""WITH {RATINGS_SQL} SELECT "userId",
        round(sum(rating) / (SELECT count(DISTINCT "movieId") FROM ratings), 6) AS mean_rating
        FROM ratings GROUP BY "userId" """,
    ),
    "item_cosine_topk": (
        lambda s, d: plan.item_neighbors(rated(s, d), 5, "movieId"),
        _vectors_sql('"movieId"') + NEIGHBORS_SQL.format(k=5),
    ),
    "title_cosine_all": (
        lambda s, d: plan.item_neighbors(rated(s, d), 1000),
        _vectors_sql("title") + NEIGHBORS_SQL.format(k=1000),
    ),
    "similar_items": (
        lambda s, d: plan.similar_items(rated(s, d), TARGET),
        _vectors_sql("title") + f"""SELECT b.id AS title,
        round(sum(a.w * b.w) / (any_value(x.norm) * any_value(y.norm)), 6) AS sim
        FROM vectors a JOIN vectors b USING (feature) JOIN norms x ON x.id = a.id JOIN norms y ON y.id = b.id
        WHERE a.id = '{TARGET}' GROUP BY b.id ORDER BY b.id <> '{TARGET}', sim DESC, b.id LIMIT 6""",
    ),
}
