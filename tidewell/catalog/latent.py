"""Latent factors, predictions, correlation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewell.catalog.collaborative import TARGET, VECTORS_SQL, rated
from tidewell.catalog.inputs import MOVIES_SQL, RATINGS_SQL, movies, ratings, table
from tidewell.functions.scoring import standardize
from tidewell.operators import factors
from tidewell.operators.ordinals import dense_ordinals
from tidewell.operators.similarity import array_vectors, pair_products, top_similar
from tidewell.plans.collaborative import rating_vectors
from tidewell.plans import latent as plan
from tidewell.session import materialize

USER = 42
GRADE = 0.92
LATENT_TARGET = "old widget"
PAIR_THRESHOLD = 0.3


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, title, rating): mean ratings per title, weighted by GRADE to the power of the title's place.

    The weights tell the singular values apart, so that all factors are determined and SQL can find them.
    """
    known = rated(spark, sf_dir).groupBy("userId", "title").agg(F.avg("rating").alias("rating"))
    places = dense_ordinals(known.select("title").distinct(), [F.col("title")], "place")
    grade = F.pow(F.lit(GRADE), F.col("place") - 1)
    return known.join(places, "title").select("userId", "title", (F.col("rating") * grade).alias("rating"))


def _graded_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every title as a movie named after its smallest product."""
    ids = movies(spark, sf_dir).groupBy("title").agg(F.min("movieId").alias("movieId"))
    known = graded(spark, sf_dir).join(ids, "title").select("userId", "movieId", "rating")
    return materialize(known, "graded-ratings")


def _embeddings(spark: SparkSession, sf_dir: str):
    return plan.title_factors(graded(spark, sf_dir))


def item_latent_neighbors(spark: SparkSession, sf_dir: str, threshold: float = 0.9) -> DataFrame:
    """Titles close to one; at a low threshold there are more than the 50 that are returned."""
    found = plan.correlated_items(_embeddings(spark, sf_dir), LATENT_TARGET, threshold)
    return found.withColumn("r", F.round("r", 4))


def latent_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of titles whose embeddings correlate."""
    found = plan.correlated_pairs(_embeddings(spark, sf_dir).embeddings(), "item", F.col("vector"))
    return found.select("left", "right", F.round("r", 4).alias("r"))


def latent_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    corner = plan.correlation_corner(_embeddings(spark, sf_dir).embeddings(), "item", F.col("vector"))
    return corner.withColumn("r", F.round("r", 4))


def _fitted(spark: SparkSession, sf_dir: str):
    """All ratings, and their model of rank 12 over every rated movie; a movie that a user rated again counts by its mean."""
    known = ratings(spark, sf_dir)
    return known, plan.fit_ratings(known, strict=False)


def svd_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for every rated movie, rated or not, of the users asked for: those whose id is divisible by 50."""
    known, model = _fitted(spark, sf_dir)
    found = plan.predict_users(model, known.where("userId % 50 = 0").select("userId").distinct())
    return found.withColumn("prediction", F.round("prediction", 4))


def svd_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    known, model = _fitted(spark, sf_dir)
    found = plan.recommend(model, known, movies(spark, sf_dir), USER, 10)[1]
    return found.withColumn("prediction", F.round("prediction", 4))


def svd_top_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three unseen movies for every user."""
    known, model = _fitted(spark, sf_dir)
    found = plan.top_unseen(model, known, known.select("userId").distinct(), 3)
    return found.select("userId", "movieId", "rank", F.round("prediction", 4).alias("prediction"))


def graded_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of every user for every title, rated or not, by a strict model of rank 12."""
    known = _graded_ratings(spark, sf_dir)
    model = plan.fit_ratings(known)
    found = plan.predict_users(model, known.select("userId").distinct())
    return found.withColumn("prediction", F.round("prediction", 4))


def _four_digits(prediction: Column) -> Column:
    """Four of six digits, halves upwards: a half is exact here, and engines differ in how they round it as a double."""
    return F.floor(prediction * 10000 + 0.5000001) / 10000


FOUR_DIGITS = "floor(round({0}, 6) * 10000 + 0.5000001) / 10000"


def graded_recommend(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _graded_ratings(spark, sf_dir)
    found = plan.recommend(plan.fit_ratings(known), known, movies(spark, sf_dir), USER, 10)[1]
    return found.withColumn("prediction", _four_digits(F.col("prediction")))


def graded_top_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three unseen titles for every user."""
    known = _graded_ratings(spark, sf_dir)
    found = plan.top_unseen(plan.fit_ratings(known), known, known.select("userId").distinct(), 3)
    return found.select("userId", "rank", _four_digits(F.col("prediction")).alias("prediction"))


def single_ratings_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user rates one product, so a product's factor is its own and its singular value its ratings' length.

    The weights set the products' lengths well apart; (item, factor, sigma) of the entries that are not zero.
    """
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey").alias("user"), F.col("l_partkey").alias("item"), "l_quantity"
    )
    weight = F.pow(F.lit(0.6), F.least(F.col("item"), F.lit(40)))
    matrix = rows.groupBy("user", "item").agg(F.sum("l_quantity").alias("q")).select("user", "item", (F.col("q") * weight).alias("rating"))
    model = factors.item_factors(materialize(matrix, "single-ratings"), plan.RANK)
    cells = model.items.select("item", F.posexplode("factor").alias("factor", "v")).where(F.abs("v") > 1e-6)
    sigma = F.array(*[F.lit(x) for x in model.sigma])
    return cells.select("item", (F.col("factor") + 1).alias("factor"), F.round("v", 6).alias("v"),
                        F.round(F.get(sigma, F.col("factor")), 6).alias("sigma"))


def line_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every distinct line of an order among all lines."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    return dense_ordinals(table(spark, sf_dir, "lineitem").select(*keys).distinct(), [F.col(k) for k in keys])


def title_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The item x item product matrix that the factors decompose."""
    vectors = materialize(rating_vectors(rated(spark, sf_dir)), "title-vectors")
    return pair_products(vectors).withColumn("product", F.round("product", 4))


def svd_full_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles as items and all factors kept: the predictions are the mean ratings again."""
    known = materialize(rated(spark, sf_dir).select("userId", F.col("title").alias("movieId"), "rating"), "title-ratings")
    n_titles = known.select("movieId").distinct().count()
    model = plan.fit_ratings(known, n_titles - 1, strict=False)
    pairs = known.select("userId", "movieId").distinct()
    return plan.predict_pairs(model, pairs).withColumn("prediction", F.round("prediction", 6))


def embedding_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    found = plan.correlations_with(table(spark, sf_dir, "embeddings"), "vec_id", vector, 0)
    return found.withColumn("r", F.round("r", 6))


def embedding_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = standardize(F.col("embedding").cast("array<double>"))
    vectors = array_vectors(table(spark, sf_dir, "embeddings"), "vec_id", unit)
    return top_similar(materialize(vectors, "embedding-vectors"), 5)


def embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of embeddings that correlate; the given ones lie far apart, hence the low threshold."""
    vector = F.col("embedding").cast("array<double>")
    found = plan.correlated_pairs(table(spark, sf_dir, "embeddings"), "vec_id", vector, PAIR_THRESHOLD)
    return found.withColumn("r", F.round("r", 6))


def embedding_corner(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    corner = plan.correlation_corner(table(spark, sf_dir, "embeddings"), "vec_id", vector)
    return corner.withColumn("r", F.round("r", 6))


def _leading_vectors(gram: str, k: int, squarings: int = 16) -> str:
    """CTEs f1 .. fk (v, value): the leading eigenvectors of the list-of-lists ``m`` of ``gram``, one after the other.

    The matrix is squared ``squarings`` times, scaled by its trace, so that neighbouring eigenvalues which differ by a
    thousandth leave less than rounding; then the vector found is taken off.
    """
    square = """list_transform(m, lambda r: list_transform(m, lambda c: list_dot_product(r, c) / (t * t)))"""
    parts = [f"m1 AS MATERIALIZED (SELECT m FROM {gram})"]
    for j in range(1, k + 1):
        parts.append(f"""p{j}(n, m) AS (
  SELECT 0, m FROM m{j}
  UNION ALL SELECT n + 1, {square} FROM (
    SELECT n, m, list_sum(list_transform(m, lambda r, i: r[i])) AS t FROM p{j} WHERE n < {squarings}))""")
        parts.append(f"""w{j} AS MATERIALIZED (SELECT list_transform(w, lambda x: x / sqrt(list_dot_product(w, w))) AS v FROM (
  SELECT list_transform(m, lambda r: list_dot_product(r, list_transform(range(1, len(m) + 1), lambda i: 1.0 / (i + {j})))) AS w
  FROM p{j} WHERE n = {squarings}))""")
        parts.append(f"""f{j} AS MATERIALIZED (SELECT list_transform(v, lambda x: x * s) AS v, value FROM (
  SELECT v, list_dot_product(v, list_transform(m, lambda r: list_dot_product(r, v))) AS value,
  sign(list_max(v) + list_min(v)) AS s FROM w{j}, m{j}))""")
        parts.append(f"""m{j + 1} AS MATERIALIZED (SELECT list_transform(range(1, len(m) + 1), lambda a:
  list_transform(range(1, len(m) + 1), lambda b: m[a][b] - value * v[a] * v[b])) AS m FROM m{j}, f{j})""")
    factors_ = " UNION ALL ".join(f"SELECT {j} AS k, v, value FROM f{j}" for j in range(1, k + 1))
    return ",\n".join([*parts, f"factors AS MATERIALIZED ({factors_})"])


GRADED_SQL = f"""means AS (SELECT "userId" AS u, title, avg(rating) AS rating FROM ratings JOIN movies USING ("movieId") GROUP BY ALL),
places AS (SELECT title, row_number() OVER (ORDER BY title) AS place, min("movieId") AS "movieId"
           FROM movies WHERE title IN (SELECT title FROM means) GROUP BY title),
graded AS (SELECT u, place, rating * pow({GRADE}, place - 1) AS x FROM means JOIN places USING (title)),
users AS (SELECT DISTINCT u FROM graded),
dense AS MATERIALIZED (SELECT u, list(coalesce(x, 0.0) ORDER BY place) AS v FROM users CROSS JOIN places LEFT JOIN graded USING (u, place) GROUP BY u)"""
GRAM_SQL = """cellsx AS (SELECT u, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM {rows}),
products AS (SELECT a.i, b.i AS j, sum(a.x * b.x) AS g FROM cellsx a JOIN cellsx b USING (u) GROUP BY ALL),
lines AS (SELECT i, list(g ORDER BY j) AS line FROM products GROUP BY i),
gram AS (SELECT list(line ORDER BY i) AS m FROM lines)"""
EMBEDDED_SQL = """WITH RECURSIVE {ratings}, {movies}, {graded}, {gram}, {power},
vectors AS (SELECT place, title, list(sqrt(value) * v[place] ORDER BY k) AS e FROM factors, places GROUP BY ALL),
middle AS (SELECT place, title, list_transform(e, lambda x: x - list_avg(e)) AS e FROM vectors),
unit AS (SELECT title, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM middle)"""
PREDICTED_SQL = """WITH RECURSIVE {ratings}, {movies}, {graded},
lowered AS MATERIALIZED (SELECT u, mean, list_transform(v, lambda x: x - mean) AS v FROM (SELECT u, v, list_avg(v) AS mean FROM dense)), {gram}, {power},
profiles AS MATERIALIZED (SELECT u, mean, k, list_dot_product(lowered.v, factors.v) AS w FROM lowered, factors),
predictions AS MATERIALIZED (SELECT u AS "userId", "movieId", sum(w * v[place]) + any_value(mean) AS prediction
                FROM profiles JOIN factors USING (k), places GROUP BY ALL),
seen AS (SELECT u AS "userId", "movieId" FROM graded JOIN places USING (place))"""


def _filled(text: str, rows: str) -> str:
    return text.format(ratings=RATINGS_SQL, movies=MOVIES_SQL, graded=GRADED_SQL, gram=GRAM_SQL.format(rows=rows),
                       power=_leading_vectors("gram", plan.RANK))


NEIGHBORS = """%s, found AS (
  SELECT b.title, list_dot_product(a.e, b.e) AS r FROM unit a, unit b WHERE a.title = '%s')
SELECT title, round(r, 4) AS r FROM found WHERE r >= {threshold} ORDER BY title LIMIT 50""" % (
    _filled(EMBEDDED_SQL, "dense"), LATENT_TARGET)
EMBEDDED, PREDICTED = _filled(EMBEDDED_SQL, "dense"), _filled(PREDICTED_SQL, "lowered")

CELLS_SQL = """cells AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i
    FROM embeddings)"""
UNITS_SQL = """lists AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings),
centred AS (SELECT vec_id, list_transform(v, lambda x: x - list_avg(v)) AS v FROM lists),
units AS (SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM centred)"""

QUERIES = {
    "item_latent_neighbors": (item_latent_neighbors, NEIGHBORS.format(threshold=0.9)),
    "item_latent_neighbors_50": (lambda s, d: item_latent_neighbors(s, d, 0.3), NEIGHBORS.format(threshold=0.3)),
    "latent_corner_block": (
        latent_corner,
        f"""{EMBEDDED}, firsts AS (SELECT * FROM unit ORDER BY title LIMIT 200)
        SELECT a.title AS left, b.title AS right, round(list_dot_product(a.e, b.e), 4) AS r
        FROM firsts a JOIN firsts b ON a.title <= b.title""",
    ),
    "latent_pairs": (
        latent_pairs,
        f"""{EMBEDDED} SELECT a.title AS left, b.title AS right, round(list_dot_product(a.e, b.e), 4) AS r
        FROM unit a JOIN unit b ON a.title < b.title WHERE list_dot_product(a.e, b.e) >= 0.9""",
    ),
    "embedding_pairs": (
        embedding_pairs,
        f"""WITH {UNITS_SQL}, folded AS (SELECT v, min(vec_id) AS id, count(*) AS n FROM units GROUP BY v)
        SELECT a.id AS left, b.id AS right, round(list_dot_product(a.v, b.v), 6) AS r, a.n AS n_left, b.n AS n_right
        FROM folded a JOIN folded b ON a.id < b.id WHERE list_dot_product(a.v, b.v) >= {PAIR_THRESHOLD}""",
    ),
    "svd_predictions": (svd_predictions, None),
    "svd_recommend": (svd_recommend, None),
    "svd_top_unseen": (svd_top_unseen, None),
    "graded_predictions": (
        graded_predictions,
        f"""{PREDICTED} SELECT "userId", "movieId", round(prediction, 4) AS prediction FROM predictions""",
    ),
    "graded_recommend": (
        graded_recommend,
        f"""{PREDICTED} SELECT movies.*, {FOUR_DIGITS.format("predictions.prediction")} AS prediction FROM predictions JOIN movies USING ("movieId")
        WHERE "userId" = {USER} AND "movieId" NOT IN (SELECT "movieId" FROM seen WHERE "userId" = {USER})
        ORDER BY round(predictions.prediction, 6) DESC, "movieId" LIMIT 10""",
    ),
    "graded_top_unseen": (
        graded_top_unseen,
        f"""{PREDICTED}, ranked AS (SELECT "userId", prediction, (row_number() OVER (PARTITION BY "userId"
        ORDER BY round(prediction, 6) DESC, "movieId"))::INT AS rank FROM predictions ANTI JOIN seen USING ("userId", "movieId"))
        SELECT "userId", rank, {FOUR_DIGITS.format("prediction")} AS prediction FROM ranked WHERE rank <= 3""",
    ),
    "single_ratings_factors": (
        single_ratings_factors,
        f"""WITH matrix AS (SELECT l_orderkey, l_linenumber, l_partkey AS item,
            sum(l_quantity) * pow(0.6, least(l_partkey, 40)) AS x FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey),
        lengths AS (SELECT item, sqrt(sum(x * x)) AS sigma FROM matrix GROUP BY item ORDER BY sigma DESC LIMIT {plan.RANK})
        SELECT item, row_number() OVER (ORDER BY sigma DESC)::INT AS factor, 1.0::DOUBLE AS v, round(sigma, 6) AS sigma FROM lengths""",
    ),
    "line_ordinals": (
        line_ordinals,
        """SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey) AS ordinal
        FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem)""",
    ),
    "title_products": (
        title_products,
        f"""WITH {RATINGS_SQL}, {MOVIES_SQL}, {VECTORS_SQL.format(item="title")}
        SELECT a.id AS left, b.id AS right, round(sum(a.w * b.w), 4) AS product
        FROM vectors a JOIN vectors b USING (feature) WHERE a.id <= b.id GROUP BY a.id, b.id""",
    ),
    "svd_full_rank": (
        svd_full_rank,
        f"""WITH {RATINGS_SQL}, {MOVIES_SQL} SELECT "userId", title AS "movieId", round(avg(rating), 6) AS prediction
        FROM ratings JOIN movies USING ("movieId") GROUP BY "userId", title""",
    ),
    "user_history": (
        lambda s, d: plan.user_history(ratings(s, d), movies(s, d), USER),
        f"""WITH {RATINGS_SQL}, {MOVIES_SQL} SELECT * FROM ratings JOIN movies USING ("movieId")
        WHERE "userId" = {USER}""",
    ),
    "unseen_items": (
        lambda s, d: plan.unseen_movies(ratings(s, d), movies(s, d), USER),
        f"""WITH {RATINGS_SQL}, {MOVIES_SQL} SELECT * FROM movies
        WHERE "movieId" NOT IN (SELECT "movieId" FROM ratings WHERE "userId" = {USER})""",
    ),
    "embedding_correlation": (
        embedding_correlation,
        f"""WITH {CELLS_SQL} SELECT b.vec_id, round(corr(a.x, b.x), 6) AS r
        FROM cells a JOIN cells b USING (i) WHERE a.vec_id = 0 GROUP BY b.vec_id""",
    ),
    "embedding_neighbors": (
        embedding_neighbors,
        f"""WITH {UNITS_SQL}, sims AS (SELECT a.vec_id AS id, b.vec_id AS neighbor,
            round(list_dot_product(a.v, b.v), 6) AS sim FROM units a JOIN units b ON a.vec_id <> b.vec_id),
        ranked AS (SELECT *, (row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbor))::INT AS rank
                   FROM sims WHERE sim > 0)
        SELECT * FROM ranked WHERE rank <= 5""",
    ),
    "embedding_corner_block": (
        embedding_corner,
        f"""WITH {UNITS_SQL}, firsts AS (SELECT * FROM units ORDER BY vec_id LIMIT 200)
        SELECT a.vec_id AS left, b.vec_id AS right, round(list_dot_product(a.v, b.v), 6) AS r
        FROM firsts a JOIN firsts b ON a.vec_id <= b.vec_id""",
    ),
}
