"""Warehouse loads, prize series and document ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell import schemas
from tidewell.catalog.inputs import MOVIES_SQL, RATINGS_SQL, land, movies, ratings, table
from tidewell.operators.latest import latest_rows, upsert_latest
from tidewell.plans import collaborative, prizes, warehouse
from tidewell.session import scratch_path
from tidewell.sinks import reports, tables
from tidewell.sources import files
from tidewell.streaming import tweets


def _segment_lines(spark: SparkSession, sf_dir: str) -> str:
    return land(table(spark, sf_dir, "customer").select("c_name", "c_mktsegment"), "segments-csv", "csv", header=True)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed two-field CSV replaces what an earlier run left."""
    target = scratch_path(spark, "segments")
    rows = files.split_fields(files.read_lines(spark, _segment_lines(spark, sf_dir)), ["name", "segment"])
    for _ in range(2):
        tables.replace(rows, target)
    return spark.read.parquet(target)


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeated append repeats its rows; rows with blank lines between them, one malformed line set aside each time."""
    target = scratch_path(spark, "segments")
    customers = table(spark, sf_dir, "customer")
    line = F.concat_ws(",", "c_name", "c_mktsegment")
    bad = F.when(F.col("c_custkey") == 1, F.lit("no segment here")).otherwise("")
    lines = customers.select(F.explode(F.array(line, bad)).alias("value"))
    landed = files.read_lines(spark, land(lines, "segments-lines", "text"), header=False)
    rows = files.split_fields(landed, ["name", "segment"], "reject")
    for _ in range(2):
        tables.append(rows, target)
    return spark.read.parquet(target)


def csv_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A movie file as it is delivered: header, commas and doubled quotes inside quoted titles."""
    title = F.concat(F.lit('The "'), "p_name", F.lit('", '), "p_brand")
    delivered = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("movieId"), title.alias("title"),
                                                    F.col("p_type").alias("genres"))
    path = land(delivered, "movies-csv", "csv", header=True, quote='"', escape='"')
    return files.read_delimited(spark, path, schemas.MOVIE)


def ratings_without_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratings file with its timestamp, joined with the movies and freed of it."""
    delivered = ratings(spark, sf_dir).withColumn("timestamp", F.col("userId") * 1000)
    landed = files.read_delimited(spark, land(delivered, "ratings-csv", "csv", header=True), schemas.RATING)
    return collaborative.rated_movies(landed, movies(spark, sf_dir))


def refresh_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed two-field file replaces the rows of a named catalog table, twice; the table is read by its name."""
    schema = f"tidewell_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        warehouse.load_name_gender(spark, _segment_lines(spark, sf_dir), schema, "name_gender")
    return spark.table(f"{schema}.name_gender")


def _forecast_document(rows: DataFrame) -> DataFrame:
    """One document whose days are the times and values of a few events, as a single file holds it."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    temp = F.struct(F.col("value").alias("day"), (F.col("value") - 5).alias("min"), (F.col("value") + 5).alias("max"))
    day = F.struct(F.timestamp_diff("SECOND", start, F.col("ts")).alias("dt"), temp.alias("temp"))
    return rows.agg(F.sort_array(F.collect_list(day)).alias("daily"))  # one entry per calendar day


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event of each day."""
    return latest_rows(table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")), ["day"],
                       [F.desc("ts"), F.desc("event_id")])


def _rounded(forecasts: DataFrame) -> DataFrame:
    return forecasts.select("date", *[F.round(c, 6).alias(c) for c in ("temp", "min_temp", "max_temp")],
                            F.col("updated_date").isNotNull().alias("dated"))


def forecast_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-file forecast documents recreate a typed catalog table; the load time fills its default column."""
    schema = f"tidewell_{uuid.uuid4().hex[:8]}"
    landed = land(_forecast_document(_daily_events(spark, sf_dir)), "forecast-json", "json")
    for _ in range(2):
        warehouse.refresh_forecast(spark, landed, schema, "forecast", "UTC")
    return _rounded(spark.table(f"{schema}.forecast"))


def forecast_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of all days, then new ones for every third day: the later load wins, other days stay."""
    target = scratch_path(spark, "forecast-table")
    days = _daily_events(spark, sf_dir)
    later = days.where(F.dayofmonth("day") % 3 == 0).withColumn("value", F.col("value") + 100)
    for rows in (days, later):
        warehouse.upsert_forecast(spark, land(_forecast_document(rows), "forecast-json", "json"), target, "UTC")
    return _rounded(warehouse.forecast_table(spark, target))


def csv_headerless(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_orderpriority"
    )
    return files.read_headerless(spark, land(rows, "orders-csv", "csv"), 3)


def weather_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a two-day forecast document."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", start, F.col("ts"))

    def day(offset: int):
        temp = F.struct(F.col("value").alias("day"), (F.col("value") - 5).alias("min"), (F.col("value") + 5).alias("max"))
        return F.struct((seconds + offset * 86400).alias("dt"), temp.alias("temp"))

    docs = table(spark, sf_dir, "events").select(F.array(day(0), day(1)).alias("daily"))
    landed = files.read_json(spark, land(docs, "forecast-json", "json"), schemas.DAILY_FORECAST)
    flat = warehouse.daily_forecast(landed, "Asia/Seoul")
    return flat.select("date", *[F.round(c, 6).alias(c) for c in ("temp", "min_temp", "max_temp")])


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks are the stored rows, all other events the new ones; one row per date."""
    rows = table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"), F.col("value").alias("temp"), "event_id", F.col("ts").alias("updated_date"),
        F.col("event_type").isin("view", "click").alias("stored"),
    )
    target = scratch_path(spark, "upsert")
    tables.replace(rows.where("stored").drop("stored"), target)
    existing = spark.read.parquet(target)
    incoming = rows.where("NOT stored").drop("stored")
    tables.replace(upsert_latest(existing, incoming, ["date"], "updated_date"), target)
    return spark.read.parquet(target)


def prize_after_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as draws: the price in thousandths is the prize, the priority digit tells the winners."""
    draws = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "P", "fail").otherwise("success").alias("returnValue"),
        F.col("o_orderkey").alias("drwNo"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("drwNoDate"),
        (F.substring("o_orderpriority", 1, 1).cast("bigint") - 1).alias("firstPrzwnerCo"),
        F.round(F.col("o_totalprice") * 1000).cast("bigint").alias("firstWinamnt"),
    )
    return prizes.prize_series(files.read_json(spark, land(draws, "draws-json", "json"), schemas.DRAW))


def _tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON lines; errors become deletion notices."""
    small = F.get_json_object("props", "$.k").cast("int") < 50
    notice = F.when(F.col("event_type") == "error", F.struct(F.col("user_id").alias("id")))
    doc = F.struct(
        F.col("event_id").cast("string").alias("created_at"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
        F.when(small, "ko").otherwise("en").alias("lang"),
        notice.alias("delete"),
    )
    return table(spark, sf_dir, "events").select("event_id", F.to_json(doc).alias("raw"))


def tweet_extract(spark: SparkSession, sf_dir: str, limit: int | None = None) -> DataFrame:
    docs = tweets.enrich(_tweets(spark, sf_dir))
    order = F.col("created_at").cast("bigint")
    stored = docs.withColumn("order", order)
    return tweets.extract(stored, "ko", limit, "order")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines land, are streamed into the store, and are extracted from it."""
    landed = land(_tweets(spark, sf_dir).select("raw"), "tweets", "text")
    store = scratch_path(spark, "tweet-store")
    query = tweets.ingest(tweets.read_line_stream(spark, landed), store, scratch_path(spark, "tweet-progress"))
    query.awaitTermination()
    return tweets.extract(files.read_connector(spark, "parquet", store))


DAYS_SQL = """days AS (SELECT ts::DATE AS date, value FROM events
    QUALIFY row_number() OVER (PARTITION BY ts::DATE ORDER BY ts DESC, event_id DESC) = 1)"""

TWEETS_SQL = """docs AS (SELECT event_id, event_id::VARCHAR AS created_at, event_type || ' ' || props AS text, event_type,
    CASE WHEN json_extract_string(props, '$.k')::INT < 50 THEN 'ko' ELSE 'en' END AS lang FROM events)"""

QUERIES = {
    "full_refresh_roundtrip": (full_refresh, "SELECT c_name AS name, c_mktsegment AS segment FROM customer"),
    "append_roundtrip": (
        append_twice,
        """SELECT c_name AS name, c_mktsegment AS segment, NULL::VARCHAR AS rejected FROM customer, range(2)
        UNION ALL SELECT NULL, NULL, 'no segment here' FROM customer, range(2) WHERE c_custkey = 1""",
    ),
    "csv_quoted": (
        csv_quoted,
        """SELECT p_partkey AS "movieId", 'The "' || p_name || '", ' || p_brand AS title, p_type AS genres FROM part""",
    ),
    "ratings_without_time": (
        ratings_without_time,
        f"""WITH {RATINGS_SQL}, {MOVIES_SQL} SELECT * FROM ratings JOIN movies USING ("movieId")""",
    ),
    "refresh_by_name": (refresh_by_name, "SELECT c_name AS name, c_mktsegment AS gender FROM customer"),
    "forecast_table": (
        forecast_table,
        f"WITH {DAYS_SQL} SELECT date, round(value, 6) AS temp, round(value - 5, 6) AS min_temp, "
        "round(value + 5, 6) AS max_temp, true AS dated FROM days",
    ),
    "forecast_upsert": (
        forecast_upsert,
        f"""WITH {DAYS_SQL}, later AS (SELECT date, value + CASE WHEN day(date) % 3 = 0 THEN 100 ELSE 0 END AS value FROM days)
        SELECT date, round(value, 6) AS temp, round(value - 5, 6) AS min_temp, round(value + 5, 6) AS max_temp,
        true AS dated FROM later""",
    ),
    "csv_headerless": (
        csv_headerless,
        """SELECT o_orderkey::VARCHAR AS _c0, nullif(o_orderstatus, 'P') AS _c1, o_orderpriority AS _c2 FROM orders""",
    ),
    "weather_flatten": (
        weather_flatten,
        """SELECT (ts + INTERVAL 9 HOUR + n * INTERVAL 1 DAY)::DATE AS date, round(value, 6) AS temp,
        round(value - 5, 6) AS min_temp, round(value + 5, 6) AS max_temp FROM events, range(2) t(n)""",
    ),
    "upsert_latest": (
        upsert,
        """SELECT date, temp, event_id, updated_date FROM (
        SELECT ts::DATE AS date, value AS temp, event_id, ts AS updated_date, row_number() OVER (PARTITION BY ts::DATE
        ORDER BY ts DESC, event_type IN ('view', 'click'), value, event_id) AS seq FROM events) WHERE seq = 1""",
    ),
    "prize_after_tax": (
        prize_after_tax,
        """WITH draws AS (SELECT o_orderkey AS "drwNo", strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderstatus,
            left(o_orderpriority, 1)::BIGINT - 1 AS winner, round(o_totalprice * 1000)::BIGINT AS winmnt FROM orders),
        shares AS (SELECT *, round_even(winmnt::DOUBLE / winner, 0) AS permnt FROM draws
                   WHERE o_orderstatus <> 'P' AND winner <> 0)
        SELECT "drwNo", date, winner, winmnt, permnt, round_even(permnt - CASE
            WHEN permnt >= 3e8 THEN 3e8 * 0.22::DOUBLE + (permnt - 3e8) * 0.33::DOUBLE
            WHEN permnt > 5000 THEN permnt * 0.22::DOUBLE ELSE 0 END, 0) AS relmnt FROM shares""",
    ),
    "tweet_extract": (
        tweet_extract,
        f"WITH {TWEETS_SQL} SELECT created_at, text FROM docs WHERE lang = 'ko' AND event_type <> 'error'",
    ),
    "tweet_extract_first10": (
        lambda s, d: tweet_extract(s, d, 10),
        f"""WITH {TWEETS_SQL}, firsts AS (SELECT * FROM docs WHERE lang = 'ko' ORDER BY event_id LIMIT 10)
        SELECT created_at, text FROM firsts WHERE event_type <> 'error'""",
    ),
    "stream_ingest": (
        stream_ingest,
        f"WITH {TWEETS_SQL} SELECT created_at, text FROM docs WHERE event_type <> 'error'",
    ),
    "profile_table": (
        lambda s, d: reports.profile(table(s, d, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))),
        """SELECT unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'])
        AS column_name, unnest(['bigint', 'bigint', 'string', 'double', 'timestamp_ntz', 'string']) AS type,
        unnest([count(o_orderkey), count(o_custkey), count(nullif(o_orderstatus, 'P')), count(o_totalprice),
        count(o_orderdate), count(o_orderpriority)]) AS non_null_count, count(*) AS row_count FROM orders""",
    ),
}
