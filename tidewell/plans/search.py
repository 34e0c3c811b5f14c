"""Product search: load, index, match, rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell import schemas
from tidewell.functions.text import tokenize
from tidewell.operators import postings, tfidf
from tidewell.session import materialize
from tidewell.sinks.tables import build_if_missing
from tidewell.sources.files import read_delimited

SCORE_DIGITS = 6


def load_products(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated (id, name) -> (id, name, token)."""
    products = read_delimited(spark, path, schemas.PRODUCT, sep="\t")
    return postings.with_tokens(products, "name")


def open_store(spark: SparkSession, raw_path: str, store: str) -> tuple[DataFrame, DataFrame]:
    """Tokenised products and their index below ``store``, built on first use."""
    data, index = f"{store}/products", f"{store}/index"
    build_if_missing(spark, data, lambda: load_products(spark, raw_path).write.mode("overwrite").parquet(data))
    build_if_missing(
        spark, index, lambda: postings.write_index(postings.inverted_index(spark.read.parquet(data)), index)
    )
    return spark.read.parquet(data), spark.read.parquet(index)


def open_weights(spark: SparkSession, products: DataFrame, store: str, max_features: int = 100) -> DataFrame:
    """Term weights over all products below ``store``, built on first use."""
    path = f"{store}/weights"

    def build():
        counts = materialize(postings.term_counts(products), "store-terms")
        tfidf.corpus_weights(counts, products.count(), max_features).write.mode("overwrite").parquet(path)

    build_if_missing(spark, path, build)
    return spark.read.parquet(path)


def search(
    products: DataFrame,
    queries: DataFrame,
    mode: str = "candidate",
    k: int = 20,
    index: DataFrame | None = None,
    weights: DataFrame | None = None,
    max_features: int = 100,
    tokenizer=tokenize,
) -> DataFrame:
    """Answer a batch of queries: (qid, rank, pid, name, score).

    ``candidate`` weighs terms within each query's own matches and sums all
    terms of a document; ``corpus`` weighs over all products, keeps the
    ``max_features`` most frequent terms and sums the query's terms only.
    A query without matches gives no rows. The products' terms are counted once and stored,
    and match, weights and scores read that table. A stored ``index`` answers the match instead,
    and stored ``weights`` the scores.
    """
    if mode not in ("candidate", "corpus"):
        raise ValueError(f"unknown mode {mode!r}")
    if "query" not in queries.columns:
        raise ValueError("queries need the columns qid and query")
    if "token" not in products.columns:
        products = postings.with_tokens(products, "name", tokenizer)
    counts = postings.term_counts(products)
    if index is None or (mode == "corpus" and weights is None):
        counts = materialize(counts, "terms")
    rows = counts if index is None else postings.posting_rows(index)
    wanted = postings.query_tokens(queries, tokenizer)
    matches = materialize(postings.conjunctive_match(rows, wanted), "matches")
    ids = matches.select("id").distinct()
    if mode == "candidate":
        scores = tfidf.scoped_scores(matches, counts)
    else:
        if weights is None:
            weights = tfidf.corpus_weights(counts, products.count(), max_features, of=ids)
        scores = tfidf.query_scores(matches, weights, wanted)
    scores = scores.withColumn("score", F.round("score", SCORE_DIGITS))
    best = materialize(postings.top_rows(scores, ["qid"], [F.desc("score"), F.col("id")], k), "best")
    return best.join(products.select("id", "name"), "id").select(
        "qid", "rank", F.col("id").alias("pid"), "name", "score"
    )
