"""Incremental upsert: the newest row of every key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.operators.postings import top_rows


def latest_rows(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    return top_rows(df, keys, order_by, 1, rank="_seq").drop("_seq")


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], updated: str) -> DataFrame:
    """Existing and incoming rows, one per key: the latest, on ties the incoming."""
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    rest = [c for c in existing.columns if c not in (*keys, updated)]
    order = [F.desc_nulls_last(updated), F.desc("_new"), *[F.col(c) for c in rest]]
    return latest_rows(both, keys, order).drop("_new")
