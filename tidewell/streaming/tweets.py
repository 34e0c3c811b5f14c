"""JSON-lines ingest into an append-only store, and extraction from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewell import schemas

BAD = "_not_parsed"


def read_line_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Files landing in ``path`` as an unbounded table of raw lines."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).withColumnRenamed("value", "raw")


def _parsed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """(doc, raw, bad) of the non-blank lines; ``bad`` is the line where it is no object of the schema."""
    whole = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    found = lines.where(F.trim("raw") != "").select(F.from_json("raw", whole, options).alias("doc"), "raw")
    return found.withColumn("bad", F.when(F.col("doc").isNull(), F.col("raw")).otherwise(F.col(f"doc.{BAD}")))


def enrich(lines: DataFrame, schema: T.StructType = schemas.TWEET) -> DataFrame:
    """Parse non-blank lines; keep the raw text and add the ingest time. ``rejected`` has the lines that can't be parsed."""
    good = _parsed(lines, schema).where("bad IS NULL")
    return good.select(*[F.col("doc")[name].alias(name) for name in schema.names], "raw", F.current_timestamp().alias("_timestamp"))


def rejected(lines: DataFrame, schema: T.StructType = schemas.TWEET) -> DataFrame:
    """The non-blank lines that are no JSON object with values of the schema's types, and the time."""
    return _parsed(lines, schema).where("bad IS NOT NULL").select("raw", F.current_timestamp().alias("_timestamp"))


def write_batch(lines: DataFrame, number: int, store: str, refused: str, stream: str, schema: T.StructType = schemas.TWEET) -> None:
    """Write one batch to folders of its own, so that a batch which is run again replaces itself."""
    lines.persist()
    for rows, folder in ((enrich(lines, schema), store), (rejected(lines, schema), refused)):
        rows.write.mode("overwrite").parquet(f"{folder}/stream={stream}/batch={number}")
    lines.unpersist()


def ingest(
    lines: DataFrame, store: str, checkpoint: str, schema: T.StructType = schemas.TWEET, refused: str | None = None, **trigger
):
    """Start appending to ``store``, and lines that can't be parsed to ``refused`` (``store`` + "-rejected"); by default
    takes all there is, then stops.

    Every line is in one of the two once: the number of a batch, and the stream that its checkpoint stands for, name its folder.
    """
    store, refused = store.rstrip("/"), refused or store.rstrip("/") + "-rejected"

    def run(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        write_batch(batch, number, store, refused, stream, schema)

    return (
        lines.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def has_key(raw: Column, key: str) -> Column:
    """True if the JSON object has ``key``, be its value null or not."""
    return F.coalesce(F.array_contains(F.json_object_keys(raw), key), F.lit(False))


def extract(
    docs: DataFrame,
    lang: str | None = None,
    limit: int | None = None,
    order_by: str | None = None,
    columns: tuple[str, ...] = ("created_at", "text"),
) -> DataFrame:
    """Stored documents of one language without deletion notices.

    ``limit`` counts documents before the notices are dropped.
    """
    if lang is not None:
        docs = docs.where(F.col("lang") == lang)
    if limit is not None:
        docs = (docs.orderBy(order_by) if order_by else docs).limit(limit)
    return docs.where(~has_key(F.col("raw"), "delete")).select(*columns)
