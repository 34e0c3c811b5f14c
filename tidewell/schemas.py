"""Declared schemas of every input and warehouse table."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
])

MOVIE = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

RATING = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

MOVIE_DETAIL = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("genres", T.StringType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("title", T.StringType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("overview", T.StringType()),
])

NAMED = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))

DAILY_FORECAST = T.StructType([
    T.StructField("daily", T.ArrayType(T.StructType([
        T.StructField("dt", T.LongType()),
        T.StructField("temp", T.StructType([
            T.StructField("day", T.DoubleType()),
            T.StructField("min", T.DoubleType()),
            T.StructField("max", T.DoubleType()),
        ])),
    ]))),
])

FORECAST_TABLE = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("temp", T.DoubleType()),
    T.StructField("min_temp", T.DoubleType()),
    T.StructField("max_temp", T.DoubleType()),
    T.StructField("updated_date", T.TimestampType()),
])

DRAW = T.StructType([
    T.StructField("returnValue", T.StringType()),
    T.StructField("drwNo", T.LongType()),
    T.StructField("drwNoDate", T.StringType()),
    T.StructField("firstPrzwnerCo", T.LongType()),
    T.StructField("firstWinamnt", T.LongType()),
])

TWEET = T.StructType([
    T.StructField("created_at", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
])
