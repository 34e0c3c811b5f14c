import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.functions.scoring import after_tax
from tidewell.functions.times import epoch_date
from tidewell.operators.latest import upsert_latest
from tidewell.plans import prizes, warehouse
from tidewell.session import discard, materialize, scratch_dir
from tidewell.sinks import reports, tables
from tidewell.sources import files

SAMPLE = {"daily": [{"dt": 1631156400, "temp": {"day": 27.92, "min": 18.47, "max": 29.73, "night": 20.0}}]}


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_two_field_lines(spark, tmp_path):
    source = write(tmp_path / "a.csv", "name,gender\nAnn,F\n\nBob,M\n'O\"Neil,M\n")
    lines = files.read_lines(spark, source)
    rows = files.split_fields(lines, ["name", "gender"]).collect()
    assert {tuple(r) for r in rows} == {("Ann", "F"), ("Bob", "M"), ("'O\"Neil", "M")}


def test_malformed_lines_fail_or_are_set_aside(spark, tmp_path):
    lines = files.read_lines(spark, write(tmp_path / "a.csv", "h,g\nAnn,F\nbad\na,b,c\n"))
    with pytest.raises(Exception, match="expected 2 fields"):
        files.split_fields(lines, ["name", "gender"]).collect()
    rows = files.split_fields(lines, ["name", "gender"], "reject").collect()
    assert {tuple(r) for r in rows} == {("Ann", "F", None), (None, None, "bad"), (None, None, "a,b,c")}


def test_lines_without_header(spark, tmp_path):
    assert files.read_lines(spark, write(tmp_path / "a.txt", "one\ntwo\n"), header=False).count() == 2


def test_lines_keep_the_unit_separator(spark, tmp_path):
    source = write(tmp_path / "a.csv", "name,gender\nAnn,F\x1fjunk,X\nBob,M\n")
    lines = files.read_lines(spark, source)
    assert {r["line"] for r in lines.collect()} == {"Ann,F\x1fjunk,X", "Bob,M"}
    with pytest.raises(Exception, match="expected 2 fields"):
        files.split_fields(lines, ["name", "gender"]).collect()


def test_malformed_documents_fail(spark, tmp_path):
    cut = write(tmp_path / "w.json", json.dumps(SAMPLE)[:-9])
    for whole in (True, False):
        with pytest.raises(Exception):
            files.read_json(spark, cut, schemas.DAILY_FORECAST, whole_file=whole).collect()
    draws = write(tmp_path / "d.json", '{"returnValue": "success", "drwNo": 1}\n{"returnValue": "succ')
    with pytest.raises(Exception):
        prizes.prize_series(files.read_json(spark, draws, schemas.DRAW)).collect()


def test_a_bad_id_fails(spark, tmp_path):
    path = write(tmp_path / "p.tsv", "id\tname\n1\ta\nx2\tb\n")
    with pytest.raises(Exception):
        files.read_delimited(spark, path, schemas.PRODUCT, sep="\t").collect()


def test_headerless_csv(spark, tmp_path):
    path = write(tmp_path / "t.csv", "1,,test1\n2,21,h\n3,22,hello\n,23,hi\n")
    want = [("1", None, "test1"), ("2", "21", "h"), ("3", "22", "hello"), (None, "23", "hi")]
    assert [tuple(r) for r in files.read_headerless(spark, path).collect()] == want
    assert [tuple(r) for r in files.read_headerless(spark, path, 3).collect()] == want


def test_quoted_fields(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'movieId,title,genres\n1,"Say ""hi"", you",A|B\n2,"two\nlines",C\n')
    rows = files.read_delimited(spark, path, schemas.MOVIE, multiline=True).collect()
    assert [r["title"] for r in rows] == ['Say "hi", you', "two\nlines"]
    inferred = files.read_delimited(spark, path, None, multiline=True)
    assert [kind for _, kind in inferred.dtypes] == ["int", "string", "string"]


def test_number_series(spark):
    assert [tuple(r) for r in files.number_series(spark, 1, 10).collect()] == [(x, 5 * x) for x in range(1, 10)]


def test_failed_replacement_leaves_the_table(spark, tmp_path):
    target = str(tmp_path / "t")
    good = spark.range(3)
    tables.replace(good, target)
    with pytest.raises(Exception):
        tables.replace(good.select(F.raise_error(F.lit("boom")).cast("long").alias("id")), target)
    assert spark.read.parquet(target).count() == 3


def test_table_may_be_replaced_by_itself(spark, tmp_path):
    target = str(tmp_path / "t")
    tables.replace(spark.range(5), target)
    tables.replace(spark.read.parquet(target).where("id > 1"), target)
    assert spark.read.parquet(target).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_interrupted_replacement_is_undone(spark, tmp_path):
    target = tmp_path / "t"
    tables.replace(spark.range(5), str(target))
    target.rename(tmp_path / "t.previous")
    tables.recover(spark, str(target))
    assert spark.read.parquet(str(target)).count() == 5


def test_append_repeats_rows(spark, tmp_path):
    for _ in range(2):
        tables.append(spark.range(3), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_catalog_refresh(spark, tmp_path):
    source = write(tmp_path / "a.csv", "name,gender\nAnn,F\nBob,M\n")
    for _ in range(2):
        warehouse.load_name_gender(spark, source, "people", "name_gender")
    assert spark.table("people.name_gender").count() == 2
    bad = write(tmp_path / "b.csv", "name,gender\nbroken\n")
    with pytest.raises(Exception, match="expected 2 fields"):
        warehouse.load_name_gender(spark, bad, "people", "name_gender")
    assert spark.table("people.name_gender").count() == 2


def test_forecast_refresh(spark, tmp_path):
    source = write(tmp_path / "w.json", json.dumps(SAMPLE, indent=1))
    for _ in range(2):
        warehouse.refresh_forecast(spark, source, "weather", "forecast")
    (row,) = spark.table("weather.forecast").collect()
    assert tuple(row)[:4] == (dt.date(2021, 9, 9), 27.92, 18.47, 29.73)
    assert row["updated_date"] is not None
    assert spark.table("weather.forecast").dtypes[0] == ("date", "date")


@pytest.mark.parametrize("source", ["missing", "malformed"])
def test_a_failing_forecast_leaves_the_tables(spark, tmp_path, source):
    good = write(tmp_path / "w.json", json.dumps(SAMPLE))
    target = str(tmp_path / "store")
    warehouse.refresh_forecast(spark, good, "weather", f"kept_{source}")
    warehouse.upsert_forecast(spark, good, target)
    bad = str(tmp_path / "gone.json") if source == "missing" else write(tmp_path / "bad.json", '{"daily": [{"dt"')
    with pytest.raises(Exception):
        warehouse.refresh_forecast(spark, bad, "weather", f"kept_{source}")
    with pytest.raises(Exception):
        warehouse.upsert_forecast(spark, bad, target)
    assert spark.table(f"weather.kept_{source}").count() == 1
    assert warehouse.forecast_table(spark, target).count() == 1


def test_upsert_touches_the_months_of_its_dates_only(spark, tmp_path):
    def days(*stamps):
        return {"daily": [{"dt": s, "temp": {"day": float(s % 97), "min": 0.0, "max": 1.0}} for s in stamps]}

    target, day = tmp_path / "store", 86400
    first = write(tmp_path / "a.json", json.dumps(days(0, 40 * day, 80 * day)))
    warehouse.upsert_forecast(spark, first, str(target), "UTC")
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in target.glob("month=*")}
    second = write(tmp_path / "b.json", json.dumps(days(40 * day + 5, 41 * day)))
    warehouse.upsert_forecast(spark, second, str(target), "UTC")
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in target.glob("month=*")}
    assert {m for m in before if before[m] != after[m]} == {"month=1970-02"}
    rows = {r["date"].isoformat(): r["temp"] for r in warehouse.forecast_table(spark, str(target)).collect()}
    assert rows == {"1970-01-01": 0.0, "1970-02-10": float((40 * day + 5) % 97), "1970-02-11": float(41 * day % 97),
                    "1970-03-22": float(80 * day % 97)}


def test_epoch_date_does_not_depend_on_the_session_zone(spark):
    late = 1631156400 + 10 * 3600  # 13:00 UTC is 22:00 in Seoul, 23:59 is the next day there
    df = spark.createDataFrame([(late,), (late + 3 * 3600,), (0,)], "s long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r["d"] for r in df.select(epoch_date(F.col("s"), "Asia/Seoul").alias("d")).collect()]
            assert got == [dt.date(2021, 9, 9), dt.date(2021, 9, 10), dt.date(1970, 1, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_upsert_forecast_keeps_past_dates(spark, tmp_path):
    target = str(tmp_path / "forecast")
    warehouse.upsert_forecast(spark, write(tmp_path / "1.json", json.dumps(SAMPLE)), target)
    newer = {"daily": [{"dt": 1631156400 + 86400 * n, "temp": {"day": n, "min": n, "max": n}} for n in (0, 1)]}
    for _ in range(2):
        warehouse.upsert_forecast(spark, write(tmp_path / "2.json", json.dumps(newer)), target)
        rows = spark.read.parquet(target).orderBy("date").collect()
        assert [(r["date"].day, r["temp"]) for r in rows] == [(9, 0.0), (10, 1.0)]
    warehouse.upsert_forecast(spark, write(tmp_path / "3.json", '{"daily": []}'), target)
    assert spark.read.parquet(target).count() == 2


def test_upsert_prefers_late_then_incoming(spark):
    schema = "k int, v string, u int"
    old = spark.createDataFrame([(1, "old", 5), (2, "old", 5), (3, "old", 5), (4, "old", None)], schema)
    new = spark.createDataFrame([(1, "new", 6), (2, "new", 5), (3, "new", 4), (4, "new", 1)], schema)
    rows = upsert_latest(old, new, ["k"], "u").orderBy("k").collect()
    assert [r["v"] for r in rows] == ["new", "new", "old", "new"]


def test_tax(spark):
    cases = {5000: 5000, 5001: 3901, 300_000_000: 234_000_000, 400_000_000: 301_000_000, 0: 0}
    df = spark.createDataFrame([(float(a),) for a in cases], "a double").select("a", after_tax(F.col("a")).alias("net"))
    assert {r["a"]: r["net"] for r in df.collect()} == cases


def test_prize_series(spark, tmp_path):
    docs = [
        {"returnValue": "success", "drwNo": 1, "drwNoDate": "2002-12-07", "firstPrzwnerCo": 0, "firstWinamnt": 0},
        {"returnValue": "success", "drwNo": 2, "drwNoDate": "2002-12-14", "firstPrzwnerCo": 2, "firstWinamnt": 5},
        {"returnValue": "fail", "drwNo": 3},
        {"returnValue": "success", "drwNo": 4, "drwNoDate": "2002-12-28", "firstPrzwnerCo": 1, "firstWinamnt": 400000000},
    ]
    for d in docs:
        write(tmp_path / f"{d['drwNo']}.json", json.dumps(d))
    draws = files.read_json(spark, str(tmp_path), schemas.DRAW, whole_file=True)
    rows = prizes.prize_series(draws, 1, 9).orderBy("drwNo").collect()
    assert [tuple(r) for r in rows] == [
        (2, "2002-12-14", 2, 5, 2.0, 2.0), (4, "2002-12-28", 1, 400000000, 400000000.0, 301000000.0)
    ]
    assert prizes.prize_series(draws, 3, 3).isEmpty()


def test_reports(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    assert [tuple(r) for r in reports.profile(df).collect()] == [("x", "int", 1, 2), ("y", "string", 2, 2)]
    assert [r[0] for r in reports.json_records(df, ["x", "y"]).collect()] == ['{"x":1,"y":"a"}', '{"x":null,"y":"b"}']


def test_discard_deletes_own_tables_only(spark, tmp_path):
    own = materialize(spark.range(3), "gone")
    discard(own)
    with pytest.raises(Exception):
        own.count()
    spark.range(3).write.parquet(str(tmp_path / "t"))
    other = spark.read.parquet(str(tmp_path / "t"))
    discard(other)
    assert other.count() == 3


def test_scratch_folder_is_the_sessions(spark):
    assert scratch_dir(spark) == spark.conf.get("spark.checkpoint.dir")
