"""Landed files and connectors as typed DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | None, sep: str = ",", multiline: bool = False
) -> DataFrame:
    """Delimited text with a header line and doubled quotes inside quoted fields.

    Without a ``schema`` the types are inferred, which reads the files once more. A value
    that is not of its column's type fails the read.
    ``multiline`` allows line breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=multiline, mode="FAILFAST")
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_headerless(spark: SparkSession, path: str, width: int | None = None) -> DataFrame:
    """CSV without header: STRING columns ``_c0 ..``, empty fields NULL.

    Naming the ``width`` spares the extra pass that finds it.
    """
    reader = spark.read.format("csv")
    if width is not None:
        reader = reader.schema(", ".join(f"_c{i} STRING" for i in range(width)))
    return reader.load(path)


def read_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Text lines as ``line``; each file's first line is dropped if it is a header.

    Blank lines are skipped. The reader splits at the unit separator; a line that
    holds one is malformed to it and comes back whole through the second column.
    """
    rows = (
        spark.read.schema("line STRING, whole STRING")
        .options(header=header, sep="\u001f", quote="", columnNameOfCorruptRecord="whole", mode="PERMISSIVE")
        .csv(path)
    )
    return rows.select(F.coalesce("whole", "line").alias("line")).where(F.col("line") != "")


def split_fields(lines: DataFrame, names: list[str], on_error: str = "fail") -> DataFrame:
    """Split ``line`` at commas into exactly ``names``.

    Other lines raise an error, or with ``on_error="reject"`` come back in a
    ``rejected`` column beside NULL fields, so that none is lost.
    """
    if on_error not in ("fail", "reject"):
        raise ValueError(f"unknown on_error {on_error!r}")
    parts = F.split("line", ",", -1)
    good = F.size(parts) == len(names)
    if on_error == "fail":
        checked = F.when(good, parts).otherwise(
            F.raise_error(F.concat(F.lit(f"expected {len(names)} fields: "), F.col("line")))
        )
        return lines.select(checked.alias("f")).select(*[F.col("f")[i].alias(n) for i, n in enumerate(names)])
    fields = [F.when(good, F.get(parts, i)).alias(n) for i, n in enumerate(names)]
    return lines.select(*fields, F.when(~good, F.col("line")).alias("rejected"))


def read_json(spark: SparkSession, path: str, schema: T.StructType, whole_file: bool = False) -> DataFrame:
    """JSON documents, one per line or one (or one array) per file, under a declared schema; a malformed one fails the read."""
    return spark.read.schema(schema).options(multiLine=whole_file, mode="FAILFAST").json(path)


def read_connector(spark: SparkSession, fmt: str = "parquet", path: str | None = None, **options) -> DataFrame:
    """Any Spark data source: a document store, JDBC, Parquet."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def number_series(spark: SparkSession, start: int, stop: int, factor: int = 5) -> DataFrame:
    """x from ``start`` to ``stop`` - 1 with y = factor * x."""
    return spark.range(start, stop).select(F.col("id").alias("x"), (F.col("id") * factor).alias("y"))
