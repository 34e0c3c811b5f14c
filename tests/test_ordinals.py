import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators.ordinals import dense_ordinals


@pytest.mark.parametrize("n", [0, 1, 5, 4000])
def test_ordinals_equal_the_sorted_order(spark, n):
    keys = [(random.Random(i).choice(["a", "b", None]), i) for i in range(n)]
    rows = dense_ordinals(spark.createDataFrame(keys, "part string, at long").repartition(3), [F.desc("part"), F.col("at")]).collect()
    want = sorted(keys, key=lambda k: (k[0] is None, -ord(k[0] or " "), k[1]))
    assert [(r["part"], r["at"]) for r in sorted(rows, key=lambda r: r["ordinal"])] == want
    assert sorted(r["ordinal"] for r in rows) == list(range(1, n + 1))


def test_no_window_over_all_rows(spark):
    table = dense_ordinals(spark.range(1000), [F.col("id")])
    assert table.columns == ["id", "ordinal"]
    assert "row_number" not in table._jdf.queryExecution().toString()


def test_equal_rows_are_numbered_too(spark):
    rows = dense_ordinals(spark.createDataFrame([("x",)] * 50 + [("a",)], "k string"), [F.col("k")]).collect()
    assert sorted(r["ordinal"] for r in rows) == list(range(1, 52)) and min(rows, key=lambda r: r["ordinal"])["k"] == "a"
