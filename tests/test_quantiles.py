import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.731, 0.9, 0.999, 1.0]


def values(kind, n=3000):
    rng = np.random.default_rng(7)
    return {
        "flat": rng.random(n) * 1e6, "ties": rng.integers(0, 5, n).astype(float), "tails": np.exp(rng.standard_normal(n) * 40),
        "signs": np.concatenate([-np.exp(rng.standard_normal(n) * 40), [0.0, -0.0], np.exp(rng.standard_normal(n) * 40)]),
        "equal": np.full(n, 2.5), "one": np.array([3.0]), "two": np.array([1.0, 2.0]), "wide": np.array([-1.7e308, -1.0, 0.0, 1e-320, 1.7e308]),
    }[kind]


@pytest.mark.parametrize("kind", ["flat", "ties", "tails", "signs", "equal", "one", "two", "wide"])
def test_quantiles_equal_sorting(spark, kind):
    x = values(kind)
    rows = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "v double").repartition(3)
    got = quantiles.exact_quantiles(rows, F.col("v"), SHARES)
    order = np.sort(x)
    for share, value in zip(SHARES, got):
        place = share * (len(x) - 1)
        left, right = order[int(np.floor(place))], order[int(np.ceil(place))]
        assert value == left + (right - left) * (place - np.floor(place))


def test_nothing_and_bad_values(spark):
    rows = spark.createDataFrame([(None,), (1.0,), (float("nan"),), (float("inf"),)], "v double")
    assert quantiles.exact_quantiles(rows.where("v IS NULL"), F.col("v"), [0.5]) == [None]
    with pytest.raises(ValueError, match="2 values"):
        quantiles.exact_quantiles(rows, F.col("v"), [0.5])
    with pytest.raises(ValueError):
        quantiles.exact_quantiles(rows, F.col("v"), [1.5])


def test_no_growing_buffer(spark, monkeypatch):
    """However many distinct values there are, a round groups by no more than the parts."""
    monkeypatch.setattr(quantiles, "BUCKETS", 16)
    rows = spark.range(20_000).selectExpr("cast(id as double) * 1.25 as v")
    assert quantiles.exact_quantiles(rows, F.col("v"), [0.5]) == [19_999 * 1.25 / 2]
