"""Tokens, index, match and ranked search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.catalog.inputs import land, products, texts, tokens_sql
from tidewell.functions.text import tokenize
from tidewell.operators import postings, tfidf
from tidewell.plans import search as plan
from tidewell.session import materialize
from tidewell.sinks.reports import json_records

TEXT_QUERIES = [
    ("articles", "the and of"),
    ("french", "LE la"),
    ("german", "der und unknownword"),
    ("repeated", "the the in"),
    ("unknown", "unknownword otherunknown"),
    ("plus", "+ ++"),
]
SEGMENT = 512


def name_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product name, shouted and with an unknown word; every first word, doubled."""
    names = products(spark, sf_dir).select("name").distinct()
    first = F.split("name", " ")[0]
    full = names.select("name", F.concat(F.upper("name"), F.lit(" unknownword")))
    twice = names.select(first, F.concat_ws(" ", first, first)).distinct()
    return full.union(twice).toDF("qid", "query")


def text_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame(TEXT_QUERIES, "qid string, query string")


NAME_QUERIES_SQL = """q AS (
  SELECT DISTINCT p_name AS qid, upper(p_name) || ' unknownword' AS query FROM part
  UNION ALL SELECT DISTINCT split_part(p_name, ' ', 1), split_part(p_name, ' ', 1) || ' ' || split_part(p_name, ' ', 1)
  FROM part)"""
TEXT_QUERIES_SQL = "q(qid, query) AS (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TEXT_QUERIES) + ")"
PRODUCTS_SQL = "docs AS (SELECT p_partkey AS id, p_name AS name FROM part)"
TEXTS_SQL = "docs AS (SELECT doc_id AS id, text AS name FROM documents)"

MATCH_SQL = f"""occ AS (SELECT id, unnest({tokens_sql('name')}) AS token FROM docs),
tc AS (SELECT id, token, count(*) AS tf FROM occ GROUP BY ALL),
qt AS (SELECT qid, token, count(*) AS times
       FROM (SELECT qid, unnest({tokens_sql('query')}) AS token FROM q) GROUP BY ALL),
known AS (SELECT qid, token FROM qt WHERE token IN (SELECT token FROM tc)),
need AS (SELECT qid, count(*) AS n FROM known GROUP BY ALL),
matched AS (SELECT qid, id FROM known JOIN tc USING (token) JOIN need USING (qid)
            GROUP BY qid, id, n HAVING count(*) = n)"""

CANDIDATE_SQL = """scope AS (SELECT qid, count(*) AS n FROM matched GROUP BY ALL),
terms AS (SELECT qid, id, token, tf FROM matched JOIN tc USING (id)),
freq AS (SELECT qid, token, count(*) AS df FROM terms GROUP BY ALL),
raw AS (SELECT qid, id, tf * (ln((n + 1) / (df + 1)) + 1) AS w
        FROM terms JOIN freq USING (qid, token) JOIN scope USING (qid)),
scores AS (SELECT qid, id, round(sum(w) / sqrt(sum(w * w)), 6) AS score FROM raw GROUP BY ALL)"""

WEIGHTS_SQL = """vocab AS (SELECT token, sum(tf) AS n, count(*) AS df FROM tc GROUP BY ALL
          ORDER BY n DESC, token LIMIT 100),
raw AS (SELECT id, token, tf * (ln((1 + (SELECT count(*) FROM docs)) / (1 + df)) + 1) AS w
        FROM tc JOIN vocab USING (token)),
weights AS (SELECT id, token, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM raw)"""

CORPUS_SQL = f"""{WEIGHTS_SQL},
scores AS (SELECT qid, id, round(sum(coalesce(weight, 0) * times), 6) AS score
           FROM matched JOIN qt USING (qid) LEFT JOIN weights USING (id, token) GROUP BY ALL)"""

RANK_SQL = """ranked AS (SELECT *, (row_number() OVER (PARTITION BY qid ORDER BY score DESC, id))::INT AS rank FROM scores),
best AS (SELECT qid, rank, id AS pid, name, score FROM ranked JOIN docs USING (id) WHERE rank <= 20)"""


def _sql(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


def _token_text(docs: DataFrame) -> DataFrame:
    return docs.select("id", tokenize(F.col("name")).alias("t")).select(
        "id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens")
    )


def _token_sql(docs: str) -> str:
    return f"""WITH {docs}, t AS (SELECT id, {tokens_sql('name')} AS t FROM docs)
    SELECT id, len(t)::INT AS n_tokens, coalesce(array_to_string(t, ' '), '') AS tokens FROM t"""


def _index(docs: DataFrame) -> DataFrame:
    return postings.inverted_index(postings.with_tokens(postings.dealt_texts(docs, "name", SEGMENT), "name"), SEGMENT)


def index_segments(docs: DataFrame) -> DataFrame:
    ids = F.array_join(F.transform("docu_list", lambda x: x.cast("string")), ",")
    return _index(docs).select("token", "segment", ids.alias("docu_list"))


def index_sizes(docs: DataFrame) -> DataFrame:
    return (
        _index(docs)
        .select("token", F.size("docu_list").alias("n"), F.size(F.array_distinct("docu_list")).alias("d"))
        .groupBy("token")
        .agg(F.sum("n").alias("n_postings"), F.sum("d").alias("n_docs"))
    )


def _segments_sql(docs: str) -> str:
    return f"""WITH {docs}, occ AS (SELECT id, unnest({tokens_sql('name')}) AS token FROM docs)
    SELECT token, id // {SEGMENT} AS segment, string_agg(id::VARCHAR, ',' ORDER BY id) AS docu_list
    FROM occ GROUP BY token, id // {SEGMENT}"""


def _sizes_sql(docs: str) -> str:
    return f"""WITH {docs}, occ AS (SELECT id, unnest({tokens_sql('name')}) AS token FROM docs)
    SELECT token, count(*) AS n_postings, count(DISTINCT id) AS n_docs FROM occ GROUP BY token"""


def search_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings.conjunctive_match(
        postings.posting_rows(_index(products(spark, sf_dir))), postings.query_tokens(name_queries(spark, sf_dir))
    )


def tfidf_weights(docs: DataFrame) -> DataFrame:
    counts = materialize(postings.term_counts(postings.with_tokens(docs, "name")), "terms")
    weights = tfidf.corpus_weights(counts, docs.count(), 100)
    return weights.select("id", "token", F.round("weight", 6).alias("weight"))


def vocabulary_top100(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = postings.term_counts(postings.with_tokens(texts(spark, sf_dir), "name"))
    return tfidf.vocabulary(counts, 100).select("token", "n", "n_docs")


def search_from_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products land as tab-separated text, the store is built, the batch is answered from it."""
    raw = land(products(spark, sf_dir), "products-tsv", "csv", sep="\t", header=True)
    data, index = plan.open_store(spark, raw, raw + "-store")
    weights = plan.open_weights(spark, data, raw + "-store")
    return plan.search(data, name_queries(spark, sf_dir), "corpus", index=index, weights=weights)


def result_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = plan.search(products(spark, sf_dir), name_queries(spark, sf_dir))
    return json_records(found, ["pid", "score", "name"])


QUERIES = {
    "tokenize_products": (lambda s, d: _token_text(products(s, d)), _token_sql(PRODUCTS_SQL)),
    "tokenize_documents": (lambda s, d: _token_text(texts(s, d)), _token_sql(TEXTS_SQL)),
    "inverted_index": (lambda s, d: index_segments(products(s, d)), _segments_sql(PRODUCTS_SQL)),
    "inverted_index_documents": (lambda s, d: index_sizes(texts(s, d)), _sizes_sql(TEXTS_SQL)),
    "search_match": (search_match, _sql(PRODUCTS_SQL, NAME_QUERIES_SQL, MATCH_SQL, select="SELECT qid, id FROM matched")),
    "search_top20_candidate": (
        lambda s, d: plan.search(products(s, d), name_queries(s, d)),
        _sql(PRODUCTS_SQL, NAME_QUERIES_SQL, MATCH_SQL, CANDIDATE_SQL, RANK_SQL, select="SELECT * FROM best"),
    ),
    "search_top20_corpus": (
        lambda s, d: plan.search(products(s, d), name_queries(s, d), "corpus"),
        _sql(PRODUCTS_SQL, NAME_QUERIES_SQL, MATCH_SQL, CORPUS_SQL, RANK_SQL, select="SELECT * FROM best"),
    ),
    "search_documents_candidate": (
        lambda s, d: plan.search(texts(s, d), text_queries(s, d)).drop("name"),
        _sql(TEXTS_SQL, TEXT_QUERIES_SQL, MATCH_SQL, CANDIDATE_SQL, RANK_SQL, select="SELECT * EXCLUDE (name) FROM best"),
    ),
    "search_documents_corpus": (
        lambda s, d: plan.search(texts(s, d), text_queries(s, d), "corpus").drop("name"),
        _sql(TEXTS_SQL, TEXT_QUERIES_SQL, MATCH_SQL, CORPUS_SQL, RANK_SQL, select="SELECT * EXCLUDE (name) FROM best"),
    ),
    "search_from_store": (
        search_from_store,
        _sql(PRODUCTS_SQL, NAME_QUERIES_SQL, MATCH_SQL, CORPUS_SQL, RANK_SQL, select="SELECT * FROM best"),
    ),
    "result_json": (
        result_json,
        _sql(PRODUCTS_SQL, NAME_QUERIES_SQL, MATCH_SQL, CANDIDATE_SQL, RANK_SQL, select="""SELECT '{"pid":' || pid
        || ',"score":' || score || ',"name":"' || name || '"}' AS record FROM best"""),
    ),
    "tfidf_weights": (
        lambda s, d: tfidf_weights(products(s, d)),
        _sql(PRODUCTS_SQL, NAME_QUERIES_SQL, MATCH_SQL, WEIGHTS_SQL,
             select="SELECT id, token, round(weight, 6) AS weight FROM weights"),
    ),
    "tfidf_weights_documents": (
        lambda s, d: tfidf_weights(texts(s, d)),
        _sql(TEXTS_SQL, TEXT_QUERIES_SQL, MATCH_SQL, WEIGHTS_SQL,
             select="SELECT id, token, round(weight, 6) AS weight FROM weights"),
    ),
    "vocabulary_top100": (
        vocabulary_top100,
        _sql(TEXTS_SQL, TEXT_QUERIES_SQL, MATCH_SQL, WEIGHTS_SQL, select="SELECT token, n::BIGINT AS n, df AS n_docs FROM vocab"),
    ),
}
