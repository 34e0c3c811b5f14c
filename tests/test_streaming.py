import json

import pytest

from tidewell.sources import files
from tidewell.streaming import tweets

LINES = [
    {"created_at": "1", "text": "하나", "lang": "ko"},
    {"created_at": "2", "text": "two", "lang": "en"},
    {"delete": {"status": {"id": 5}}, "lang": "ko", "created_at": "3"},
    {"created_at": "4", "text": "넷", "lang": "ko", "delete": None},
    {"created_at": "5", "text": "다섯", "lang": "ko", "nested": {"delete": 1}},
]


def drop(folder, name, docs):
    (folder / name).write_text("\n".join(json.dumps(d, ensure_ascii=False) for d in docs) + "\n\n", encoding="utf-8")


@pytest.fixture
def landed(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    drop(folder, "a.json", LINES)
    return folder


def run(spark, landed, tmp_path, **trigger):
    lines = tweets.read_line_stream(spark, str(landed), files_per_trigger=1)
    tweets.ingest(lines, str(tmp_path / "store"), str(tmp_path / "progress"), **trigger).awaitTermination()
    return files.read_connector(spark, "parquet", str(tmp_path / "store"))


def test_stream_equals_batch(spark, landed, tmp_path):
    stored = run(spark, landed, tmp_path)
    batch = tweets.enrich(spark.read.text(str(landed)).withColumnRenamed("value", "raw"))
    columns = ["created_at", "text", "lang", "raw"]
    assert sorted(map(str, stored.select(*columns).collect())) == sorted(map(str, batch.select(*columns).collect()))
    assert stored.where("_timestamp IS NULL").isEmpty() and stored.count() == 5


def test_restart_takes_new_files_only(spark, landed, tmp_path):
    run(spark, landed, tmp_path)
    drop(landed, "b.json", [{"created_at": "6", "text": "six", "lang": "en"}])
    assert run(spark, landed, tmp_path).count() == 6
    assert run(spark, landed, tmp_path).count() == 6


def test_deletion_notices_are_those_with_the_key(spark, landed, tmp_path):
    stored = run(spark, landed, tmp_path)
    assert sorted(r["created_at"] for r in tweets.extract(stored).collect()) == ["1", "2", "5"]
    assert sorted(r["text"] for r in tweets.extract(stored, "ko").collect()) == ["다섯", "하나"]


def test_limit_counts_before_notices_are_dropped(spark, landed, tmp_path):
    stored = run(spark, landed, tmp_path)
    assert [r["text"] for r in tweets.extract(stored, "ko", 2, "created_at").collect()] == ["하나"]


def test_lines_that_do_not_parse_are_kept_apart(spark, landed, tmp_path):
    bad = ["{oops", "[1, 2]", '"text"', '{"created_at": "7", "text": "cut']
    (landed / "b.json").write_text("\n".join([bad[0], json.dumps(LINES[1]), "", "   ", *bad[1:], "null"]), encoding="utf-8")
    stored = run(spark, landed, tmp_path)
    assert stored.count() == 6 and stored.where("raw IS NULL").isEmpty()
    refused = files.read_connector(spark, "parquet", str(tmp_path / "store-rejected"))
    assert sorted(r["raw"] for r in refused.collect()) == sorted([*bad, "null"])
    assert refused.where("_timestamp IS NULL").isEmpty()
    assert tweets.extract(stored).where("text IS NULL").isEmpty()


def test_a_batch_that_runs_again_replaces_itself(spark, landed, tmp_path):
    store, refused = str(tmp_path / "again"), str(tmp_path / "refused")
    lines = spark.read.text(str(landed)).withColumnRenamed("value", "raw").union(spark.createDataFrame([("{",)], "raw string"))
    for number in (0, 1, 1, 0):
        tweets.write_batch(lines, number, store, refused, "s")
    assert spark.read.parquet(store).count() == 10 and spark.read.parquet(refused).count() == 2
    tweets.write_batch(lines, 0, store, refused, "another checkpoint")
    assert spark.read.parquet(store).count() == 15
