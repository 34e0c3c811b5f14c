"""Term weights in long form, over a corpus or per query scope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.session import materialize


def smooth_idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log((n_docs + 1) / (doc_freq + 1)) + 1


def vocabulary(counts: DataFrame, max_features: int | None = None) -> DataFrame:
    """(token, n, n_docs): all terms, or the most frequent ones, ties by token."""
    terms = counts.groupBy("token").agg(F.sum("tf").alias("n"), F.count("*").alias("n_docs"))
    if max_features is None:
        return terms
    return terms.orderBy(F.desc("n"), "token").limit(max_features)


def corpus_weights(
    counts: DataFrame, n_docs: int, max_features: int | None = None, of: DataFrame | None = None
) -> DataFrame:
    """(id, token, weight): unit-length rows, idf over the whole corpus.

    ``counts`` are the stored (id, token, tf) of a corpus of ``n_docs``. ``of`` (id) names the
    documents whose rows are wanted, by default all.
    """
    terms = materialize(vocabulary(counts, max_features).select("token", "n_docs"), "vocabulary")
    wanted = counts if of is None else counts.join(of, "id", "left_semi")
    raw = wanted.join(terms, "token").select(
        "id", "token", (F.col("tf") * smooth_idf(F.lit(n_docs), F.col("n_docs"))).alias("raw")
    )
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))
    return raw.select("id", "token", (F.col("raw") / length).alias("weight"))


def scoped_scores(matches: DataFrame, counts: DataFrame) -> DataFrame:
    """(qid, id, score) where each query's matches are a corpus of their own.

    The score of a document sums the unit-length weights of all its terms. The counts per
    (query, token) are stored first: the join with them then is between two plain
    scans, of which the planner splits a token that all matches of a query share.
    """
    scope = matches.groupBy("qid").agg(F.count("*").alias("n_scope"))
    terms = materialize(matches.join(counts, "id"), "scoped-terms")
    freq = terms.groupBy("qid", "token").agg(F.count("*").alias("n_docs")).join(scope, "qid")
    freq = materialize(freq, "scoped-frequencies")
    raw = F.col("tf") * smooth_idf(F.col("n_scope"), F.col("n_docs"))
    return (
        terms.join(freq, ["qid", "token"])
        .withColumn("raw", raw)
        .groupBy("qid", "id")
        .agg((F.sum("raw") / F.sqrt(F.sum(F.col("raw") * F.col("raw")))).alias("score"))
    )


def query_scores(matches: DataFrame, weights: DataFrame, wanted: DataFrame) -> DataFrame:
    """(qid, id, score): corpus weights of the query's terms, repeats counted."""
    return (
        matches.join(wanted, "qid")
        .join(weights, ["id", "token"], "left")
        .groupBy("qid", "id")
        .agg(F.sum(F.coalesce(F.col("weight"), F.lit(0.0)) * F.col("times")).alias("score"))
    )
