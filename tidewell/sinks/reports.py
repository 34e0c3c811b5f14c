"""Results as JSON records, and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def json_records(df: DataFrame, columns: list[str], alias: str = "record") -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(alias))


def profile(df: DataFrame) -> DataFrame:
    """(column_name, type, non_null_count, row_count) in a single pass."""
    counts = df.agg(
        F.count("*").alias("row_count"),
        F.struct(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).alias("n"),
    )
    lines = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("type"),
            F.col("n").getField(name).alias("non_null_count"),
        )
        for name, kind in df.dtypes
    ]
    return counts.select("row_count", F.explode(F.array(*lines)).alias("line")).select("line.*", "row_count")
