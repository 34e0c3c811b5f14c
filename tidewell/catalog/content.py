"""Content-based recommendation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.catalog.inputs import DETAILS_SQL, movie_details, movies, table
from tidewell.functions.text import nested_names
from tidewell.operators.quantiles import exact_quantiles
from tidewell.plans import content as plan
from tidewell.session import materialize

TARGET = 17
SHARES = [0.05, 0.25, 0.5, 0.9, 0.99]


def weighted_rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = plan.with_score(movie_details(spark, sf_dir))
    return scored.select("id", "title", "vote_count", F.round("vote_average", 6).alias("vote_average"),
                         F.round("score", 6).alias("score"))


def price_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of a column that has nearly as many distinct values as rows."""
    found = exact_quantiles(table(spark, sf_dir, "orders"), F.col("o_totalprice"), SHARES)
    return spark.createDataFrame(list(zip(SHARES, found)), "share double, price double").withColumn("price", F.round("price", 4))


def flat_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = movie_details(spark, sf_dir)
    return details.select("id", nested_names(F.col("genres")).alias("genres"),
                          nested_names(F.col("keywords")).alias("keywords"))


def literal_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a name in a cell of Python notation, with quotes of both kinds; every seventh cell is cut off."""
    quote = F.when(F.col("doc_id") % 3 == 1, F.lit('"')).otherwise("'")
    text = F.replace(F.replace("text", F.lit("\\"), F.lit(r"\\")), quote, F.concat(F.lit("\\"), quote))
    text = F.replace(F.replace(text, F.lit("\n"), F.lit(r"\n")), F.lit("\r"), F.lit(r"\x0d"))
    cell = F.concat(F.lit("[{'id': None, 'name': "), quote, text, quote, F.lit(", 'main': True}, {'id': "), "doc_id", F.lit("}"))
    end = F.when(F.col("doc_id") % 7 == 0, F.lit("")).otherwise("]")
    cells = table(spark, sf_dir, "documents").select("doc_id", F.concat(cell, end).alias("cell"))
    return cells.select("doc_id", nested_names(F.col("cell"), "null").alias("names"))


def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = movies(spark, sf_dir).withColumnRenamed("movieId", "id")
    return plan.ngram_counts(items, F.concat_ws(" ", "title", "genres"))


def similar_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = movies(spark, sf_dir).withColumnRenamed("movieId", "id")
    return plan.similar_movies(items, F.col("genres"), 5)


def content_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recommendations for one product among all of them, however few votes they have."""
    scored = plan.prepare(movie_details(spark, sf_dir), share=0.0).withColumn("score", F.round("score", 6))
    return plan.recommend(materialize(scored, "scored"), TARGET).select("id", "title", "genres", "sim", "score")


def recommend_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain with the vote filter on, for the first title that survives it; several products share a title."""
    scored = plan.prepare(movie_details(spark, sf_dir)).withColumn("score", F.round("score", 6))
    scored = materialize(scored, "scored")
    title = scored.agg(F.min("title")).first()[0]
    return plan.recommend_by_title(scored, title).select("id", "title", "genres", "sim", "score")


GRAMS_SQL = """words AS (SELECT id, regexp_extract_all(lower(text), '\\b\\w\\w+\\b') AS w FROM texts),
grams AS (SELECT id, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i+1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]))) AS ngram FROM words),
counts AS (SELECT id, ngram, count(*) AS n FROM grams GROUP BY ALL)"""

SCORED_SQL = """floor AS (SELECT quantile_cont(vote_count, {share}) AS m FROM details),
kept AS (SELECT details.* FROM details, floor WHERE vote_count >= m),
scored AS (SELECT kept.*, round(vote_count / (vote_count + m) * vote_average
    + m / (vote_count + m) * (SELECT avg(vote_average) FROM kept), 6) AS score FROM kept, floor)"""

QUERIES = {
    "weighted_rating": (
        weighted_rating,
        f"WITH {DETAILS_SQL}, {SCORED_SQL.format(share=0.9)} "
        "SELECT id, title, vote_count, round(vote_average, 6) AS vote_average, score FROM scored",
    ),
    "price_quantiles": (
        price_quantiles,
        f"""SELECT unnest({SHARES})::DOUBLE AS share, round(unnest(quantile_cont(o_totalprice::DOUBLE, {SHARES})), 4) AS price
        FROM orders""",
    ),
    "nested_names": (
        flat_genres,
        f"WITH {DETAILS_SQL} SELECT id, genres, title AS keywords FROM details",
    ),
    "literal_cells": (
        literal_cells, "SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN text END AS names FROM documents",
    ),
    "ngram_counts": (
        ngram_counts,
        "WITH texts AS (SELECT p_partkey AS id, p_name || ' ' || p_type || ' ' || p_brand AS text FROM part), "
        f"{GRAMS_SQL} SELECT * FROM counts",
    ),
    "content_similar_topk": (
        similar_movies,
        f"""WITH texts AS (SELECT DISTINCT p_type || ' ' || p_brand AS id, p_type || ' ' || p_brand AS text FROM part),
        {GRAMS_SQL},
        norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY ALL),
        dots AS (SELECT a.id AS one, b.id AS two, sum(a.n * b.n) AS dot
                 FROM counts a JOIN counts b USING (ngram) GROUP BY ALL),
        sims AS (SELECT one, two, round(dot / (x.norm * y.norm), 6) AS sim
                 FROM dots JOIN norms x ON one = x.id JOIN norms y ON two = y.id),
        items AS (SELECT p_partkey AS id, p_type || ' ' || p_brand AS text FROM part),
        ranked AS (SELECT l.id, r.id AS neighbor, sim,
                   (row_number() OVER (PARTITION BY l.id ORDER BY sim DESC, r.id))::INT AS rank
                   FROM items l JOIN sims ON l.text = one JOIN items r ON r.text = two WHERE l.id <> r.id AND sim > 0)
        SELECT * FROM ranked WHERE rank <= 5""",
    ),
    "content_recommend": (
        content_recommend,
        f"""WITH {DETAILS_SQL}, {SCORED_SQL.format(share=0.0)},
        texts AS (SELECT id, genres AS text FROM details), {GRAMS_SQL},
        norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY ALL),
        sims AS (SELECT b.id, sum(a.n * b.n) / (any_value(x.norm) * any_value(y.norm)) AS sim
                 FROM counts a JOIN counts b USING (ngram) JOIN norms x ON x.id = a.id JOIN norms y ON y.id = b.id
                 WHERE a.id = {TARGET} GROUP BY b.id),
        near AS (SELECT id, title, genres, round(coalesce(sim, 0), 6) AS sim, score
                 FROM scored LEFT JOIN sims USING (id)
                 ORDER BY id <> {TARGET}, 4 DESC, id LIMIT 30)
        SELECT * FROM near WHERE id <> {TARGET} ORDER BY score DESC, id LIMIT 10""",
    ),
    "content_by_title": (
        recommend_by_title,
        f"""WITH {DETAILS_SQL}, {SCORED_SQL.format(share=0.9)},
        texts AS (SELECT id, genres AS text FROM scored), {GRAMS_SQL},
        norms AS (SELECT id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY ALL),
        targets AS (SELECT id AS target FROM scored WHERE title = (SELECT min(title) FROM scored)),
        dots AS (SELECT a.id AS target, b.id, sum(a.n * b.n) / (any_value(x.norm) * any_value(y.norm)) AS sim
                 FROM counts a JOIN targets ON a.id = target JOIN counts b USING (ngram)
                 JOIN norms x ON x.id = a.id JOIN norms y ON y.id = b.id GROUP BY a.id, b.id),
        every AS (SELECT target, scored.id, round(coalesce(sim, 0), 6) AS sim
                  FROM scored CROSS JOIN targets LEFT JOIN dots USING (target, id)),
        near AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY target ORDER BY id <> target, sim DESC, id) <= 30),
        best AS (SELECT id, max(sim) AS sim FROM near WHERE id NOT IN (SELECT target FROM targets) GROUP BY id)
        SELECT id, title, genres, sim, score FROM best JOIN scored USING (id) ORDER BY score DESC, id LIMIT 10""",
    ),
}
