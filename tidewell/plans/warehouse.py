"""Warehouse loads: two-field CSV, weather forecast, upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell import schemas
from tidewell.functions.times import epoch_date
from tidewell.operators.latest import upsert_latest
from tidewell.sinks import tables
from tidewell.sources import files


def load_name_gender(spark: SparkSession, source: str, schema: str, table: str, on_error: str = "fail") -> None:
    """Full refresh of a (name, gender) table from a CSV file with a header."""
    rows = files.split_fields(files.read_lines(spark, source), ["name", "gender"], on_error)
    tables.full_refresh(rows, schema, table)


def daily_forecast(documents: DataFrame, tz: str = "Asia/Seoul") -> DataFrame:
    """Forecast documents -> (date, temp, min_temp, max_temp)."""
    return documents.select(F.explode("daily").alias("d")).select(
        epoch_date(F.col("d.dt"), tz).alias("date"),
        F.col("d.temp.day").alias("temp"),
        F.col("d.temp.min").alias("min_temp"),
        F.col("d.temp.max").alias("max_temp"),
    )


def read_forecast(spark: SparkSession, path: str, tz: str = "Asia/Seoul") -> DataFrame:
    return daily_forecast(files.read_json(spark, path, schemas.DAILY_FORECAST, whole_file=True), tz)


def refresh_forecast(spark: SparkSession, source: str, schema: str, table: str, tz: str = "Asia/Seoul") -> None:
    """Create the typed forecast table anew and fill it; a failing source leaves the old table."""
    rows = tables.with_default_now(read_forecast(spark, source, tz), "updated_date")
    tables.recreate(rows, schema, table, schemas.FORECAST_TABLE)


def upsert_forecast(spark: SparkSession, source: str, target: str, tz: str = "Asia/Seoul") -> None:
    """Merge new forecasts into the table at ``target``, stored by month: latest row per date."""
    incoming = tables.with_default_now(read_forecast(spark, source, tz), "updated_date")
    tables.merge_partitions(
        incoming, target, F.date_format("date", "yyyy-MM"), "month",
        lambda stored, fresh: upsert_latest(stored, fresh, ["date"], "updated_date"),
    )


def forecast_table(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a table that ``upsert_forecast`` keeps."""
    return spark.read.schema(schemas.FORECAST_TABLE).parquet(target)
