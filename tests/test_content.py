import json

import pytest
from pyspark.sql import functions as F

from tidewell.functions.scoring import weighted_rating
from tidewell.plans import content
from tidewell.schemas import MOVIE_DETAIL


def test_weighted_rating(spark):
    row = spark.range(1).select(weighted_rating(F.lit(2), F.lit(8.0), F.lit(2.0), F.lit(6.0)).alias("s")).first()
    assert row["s"] == 7.0


@pytest.fixture(scope="module")
def details(spark):
    kinds = ["Action Thriller", "Action", "Drama Romance", "Action Thriller", "Comedy", "x"]
    rows = [
        (i, json.dumps([{"id": 1, "name": w} for w in kinds[i % 6].split()]), 5.0 + i % 4, 10 * i + 10, 1.0, f"m{i}", "[]", "")
        for i in range(40)
    ]
    return spark.createDataFrame(rows, MOVIE_DETAIL)


def test_only_well_voted_movies_are_scored(spark, details):
    rows = content.with_score(details, 0.9).collect()
    assert sorted(r["id"] for r in rows) == [36, 37, 38, 39]  # quantile 361
    mean = sum(5.0 + r["id"] % 4 for r in rows) / 4
    for r in rows:
        v = r["vote_count"]
        assert r["score"] == pytest.approx(v / (v + 361) * r["vote_average"] + 361 / (v + 361) * mean)


def test_recommendation_ranks_near_movies_by_score(spark, details):
    movies = content.prepare(details, 0.0)
    rows = content.recommend(movies, 0, top=8, n=5).collect()
    assert [r["id"] for r in rows if r["id"] == 0] == []
    twins = [i for i in range(1, 40) if i % 6 in (0, 3)][:7]  # itself takes one of the eight places
    scores = {r["id"]: r["score"] for r in movies.collect()}
    assert [r["id"] for r in rows] == sorted(twins, key=lambda i: (-scores[i], i))[:5]


def test_movies_without_words_are_neighbours_of_similarity_zero(spark, details):
    rows = content.recommend(content.prepare(details, 0.0), 5, top=4, n=10).collect()
    assert [(r["id"], r["sim"]) for r in sorted(rows, key=lambda r: r["id"])] == [(0, 0.0), (1, 0.0), (2, 0.0)]


def test_copies_are_compared_once_yet_all_listed(spark):
    texts = {i: "action thriller" for i in range(300)} | {300: "action", 301: "drama", 302: "Action Thriller war", 303: "?"}
    movies = spark.createDataFrame(list(texts.items()), "id long, text string")
    got = {}
    for r in content.similar_movies(movies, F.col("text"), 4).collect():
        got.setdefault(r["id"], []).append((r["rank"], r["neighbor"], r["sim"]))
    one, other = round(1 / 3**0.5, 6), round(3 / (3 * 6) ** 0.5, 6)
    assert sorted(got[0]) == [(i, i, 1.0) for i in (1, 2, 3, 4)]
    assert sorted(got[299]) == [(i + 1, i, 1.0) for i in range(4)]
    assert sorted(got[300]) == [(i + 1, i, one) for i in range(4)]
    assert sorted(got[302]) == [(i + 1, i, other) for i in range(4)]
    assert 301 not in got and 303 not in got and len(got) == 302


def test_ngrams_are_counted_without_shuffling_them(spark, monkeypatch):
    monkeypatch.setattr(content, "TASK_LETTERS", 10)
    rows = [(i % 7, f"red blue red {i}") for i in range(50)] + [(None, "red"), (3, None)]
    found = content.ngram_counts(spark.createDataFrame(rows, "id long, text string"), F.col("text"))
    assert found.rdd.getNumPartitions() >= 50
    got = {(r["id"], r["ngram"]): r["n"] for r in found.collect()}
    assert got[(0, "red")] == 16 and got[(0, "red blue red")] == 8 and got[(None, "red")] == 1


def test_recommendations_write_few_rows_however_many_copies(spark, monkeypatch):
    """All movies of a title and their copies: what is compared are the distinct texts."""
    kept = []
    materialize = content.materialize
    monkeypatch.setattr(content, "materialize", lambda df, label: kept.append((label, materialize(df, label))) or kept[-1][1])
    rows = [(i, "same" if i % 2 else f"t{i}", ["action war", "Action War", "drama"][i % 3], float(i)) for i in range(240)]
    rows += [(240, "other", "war", 1.0), (240, "other", "drama", 1.0)]
    movies = spark.createDataFrame(rows, "id long, title string, genres string, score double")
    found = content.recommend_by_title(movies, "same", top=130, n=5).collect()
    sizes = {label: table.count() for label, table in kept}
    assert sizes["content-groups"] == 2 and sizes["content-vectors"] <= 9
    assert [(r["id"], r["sim"]) for r in found] == [(r, 1.0) for r in (236, 230, 224, 218, 212)]
