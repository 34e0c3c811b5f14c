"""Inverted index in bounded segments, and the conjunctive match on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.functions.text import tokenize
from tidewell.session import materialize

SEGMENT_IDS = 4096
TASK_LETTERS = 2_000_000


def with_tokens(docs: DataFrame, text: str, tokenizer=tokenize) -> DataFrame:
    return docs.withColumn("token", tokenizer(F.col(text)))


def _segment(segment_ids: int) -> Column:
    return F.expr(f"(cast(id AS BIGINT) - pmod(cast(id AS BIGINT), {segment_ids})) div {segment_ids}").alias("segment")


def dealt_texts(docs: DataFrame, text: str, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """``docs`` with their segment, dealt by it into as many tasks as the length of the texts asks for.

    Tokens are then taken and counted, and lists of a segment made, without another shuffle.
    """
    length = docs.agg(F.coalesce(F.sum(F.length(text)), F.lit(0))).first()[0]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.select("*", _segment(segment_ids)).repartition(max(n, -(-length // TASK_LETTERS)), "segment")


def term_counts(docs: DataFrame, *kept: str) -> DataFrame:
    """(id, token ARRAY) -> (id, token, tf), with the columns ``kept`` that go by id.

    The outer explode keeps the planner from testing the list for being empty
    in the scan, which would run the tokenizer a second time.
    """
    rows = docs.select("id", *kept, F.explode_outer("token").alias("token")).where(F.col("token").isNotNull())
    return rows.groupBy("id", *kept, "token").agg(F.count("*").alias("tf"))


def inverted_index(docs: DataFrame, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """(id, token ARRAY) -> (token, segment, docu_list).

    ``docu_list`` holds one id per occurrence in id order. A token's list is cut
    into ranges of ``segment_ids`` ids, so that a token found in every document
    becomes many rows spread over all tasks instead of one row of any length.
    Ids are integers; a string id is cast, and one that is no integer fails.
    ``docs`` of ``dealt_texts``, with the same ``segment_ids``, are not shuffled again.
    """
    if "segment" not in docs.columns:
        docs = docs.select("*", _segment(segment_ids))
    repeated = F.transform(
        F.array_sort(F.collect_list(F.struct("id", "tf"))), lambda x: F.array_repeat(x["id"], x["tf"].cast("int"))
    )
    return (
        term_counts(docs, "segment")
        .groupBy("token", "segment")
        .agg(F.flatten(repeated).alias("docu_list"))
    )


def write_index(index: DataFrame, path: str) -> None:
    """Store the index ordered by token, so a probe reads few row groups."""
    (
        index.repartitionByRange("token", "segment")
        .sortWithinPartitions("token", "segment")
        .write.mode("overwrite")
        .parquet(path)
    )


def posting_rows(index: DataFrame) -> DataFrame:
    """Distinct (token, id); an id lies in one segment only, so no shuffle."""
    return index.select("token", F.explode(F.array_distinct("docu_list")).alias("id"))


def query_tokens(queries: DataFrame, tokenizer=tokenize) -> DataFrame:
    """(qid, query) -> (qid, token, times)."""
    return (
        queries.select("qid", F.explode(tokenizer(F.col("query"))).alias("token"))
        .groupBy("qid", "token")
        .agg(F.count("*").alias("times"))
    )


def conjunctive_match(postings: DataFrame, wanted: DataFrame) -> DataFrame:
    """(qid, id) of the documents that hold every known token of the query.

    ``postings`` has distinct (token, id). Tokens it does not know are ignored. Each query starts from its
    rarest token; the other tokens only filter those candidates by (token, id),
    so a common token never multiplies with the queries that use it. The postings
    are read once and kept for the queried tokens only.
    """
    wanted = materialize(wanted, "query-tokens")
    hits = materialize(
        postings.join(wanted.select("token").distinct(), "token", "left_semi").select("token", "id"), "query-postings"
    )
    sizes = hits.groupBy("token").agg(F.count("*").alias("n_docs"))
    per_query = Window.partitionBy("qid")
    known = (
        wanted.select("qid", "token")
        .join(sizes, "token")
        .withColumn("n_known", F.count("*").over(per_query))
        .withColumn("rarity", F.row_number().over(per_query.orderBy("n_docs", "token")))
    )
    candidates = known.where("rarity = 1").join(hits, "token").select("qid", "id", "n_known")
    others = known.where("rarity > 1").select("qid", "token")
    confirmed = (
        candidates.join(others, "qid")
        .join(hits, ["token", "id"], "left_semi")
        .groupBy("qid", "id")
        .agg(F.count("*").alias("n_found"))
    )
    return (
        candidates.join(confirmed, ["qid", "id"], "left")
        .where(F.coalesce("n_found", F.lit(0)) == F.col("n_known") - 1)
        .select("qid", "id")
    )


def top_rows(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per group; every task keeps at most ``k`` of each."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col(rank) <= k)
