"""Views of the given tables in the shape the workloads expect, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("name"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"), F.col("l_partkey").alias("movieId"), F.col("l_quantity").alias("rating")
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movieId"),
        F.col("p_name").alias("title"),
        F.concat_ws(" ", "p_type", "p_brand").alias("genres"),
    )


def movie_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as movies: votes are their ratings, genres a nested cell of type and brand."""
    votes = ratings(spark, sf_dir).groupBy("movieId").agg(
        F.avg("rating").alias("vote_average"), F.count("*").alias("vote_count")
    )
    cell = F.to_json(F.array(F.struct(F.lit(1).alias("id"), F.col("p_type").alias("name")),
                             F.struct(F.lit(2).alias("id"), F.col("p_brand").alias("name"))))
    words = F.to_json(F.array(F.struct(F.col("p_name").alias("name"))))
    return (
        table(spark, sf_dir, "part")
        .join(votes, F.col("p_partkey") == F.col("movieId"))
        .select(
            F.col("p_partkey").alias("id"), cell.alias("genres"), "vote_average", "vote_count",
            F.col("p_retailprice").alias("popularity"), F.col("p_name").alias("title"),
            words.alias("keywords"), F.col("p_type").alias("overview"),
        )
    )


def land(df: DataFrame, label: str, fmt: str, **options) -> str:
    """Write rows as the files an outside system would deliver; gives their path."""
    path = scratch_path(df.sparkSession, label)
    df.write.format(fmt).options(**options).save(path)
    return path


RATINGS_SQL = """ratings AS (
  SELECT o_custkey AS "userId", l_partkey AS "movieId", l_quantity AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES_SQL = """movies AS (
  SELECT p_partkey AS "movieId", p_name AS title, p_type || ' ' || p_brand AS genres FROM part)"""

DETAILS_SQL = f"""{RATINGS_SQL}, details AS (
  SELECT p_partkey AS id, p_type || ' ' || p_brand AS genres, vote_average, vote_count, p_name AS title
  FROM part JOIN (SELECT "movieId", avg(rating) AS vote_average, count(*) AS vote_count
                  FROM ratings GROUP BY ALL) ON p_partkey = "movieId")"""

# Fixed value: the product token pattern in the notation of the SQL engine.
TOKEN_SQL = (
    r"[가-힣]+|[ㄱ-ㅎ|ㅏ-ㅣ]+|[a-z0-9-]+|[^\s\x0b\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}a-z0-9가-힣+]"
)


def tokens_sql(column: str) -> str:
    return f"regexp_extract_all(lower({column}), '{TOKEN_SQL}')"
