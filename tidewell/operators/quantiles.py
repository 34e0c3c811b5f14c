"""Exact quantiles of a column of any size, by rounds of histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 4096


def exact_quantiles(rows: DataFrame, column: Column, shares: list[float]) -> list[float | None]:
    """The quantiles of ``column`` at ``shares``, interpolated between neighbours; nulls don't count.

    A round counts the values of each interval that still holds a wanted rank in BUCKETS equal parts, and goes on with
    the smallest and largest value of the one part; an interval ends when these are the same. What a round
    groups by, and what the driver sees, does not grow with the rows or with the distinct values. The column is read once
    a round: hand over a stored table. Without values all quantiles are null; infinite values and NaN are refused.
    """
    if not all(0 <= share <= 1 for share in shares):
        raise ValueError("shares lie between 0 and 1")
    x = F.col("x")
    values = rows.select(column.cast("double").alias("x")).where(x.isNotNull())
    odd = F.count_if(F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    n, low, high, bad = values.agg(F.count("*"), F.min("x"), F.max("x"), odd).first()
    if not n:
        return [None] * len(shares)
    if bad:
        raise ValueError(f"{bad} values are infinite or no numbers")
    places = [share * (n - 1) for share in shares]
    at = {rank: (low, high, 0) for place in places for rank in (math.floor(place), math.ceil(place))}
    while True:
        intervals = sorted({(a, b) for a, b, _ in at.values() if a < b})
        if not intervals:
            break
        number, part = F.lit(None).cast("int"), F.lit(None).cast("double")
        for i, (a, b) in enumerate(intervals):
            inside = x.between(a, b)
            number = F.when(inside, i).otherwise(number)
            part = F.when(inside, F.floor((x / 2 - a / 2) / (b / 2 - a / 2) * BUCKETS)).otherwise(part)
        counted = values.select("x", number.alias("i"), part.alias("part")).where("i IS NOT NULL")
        found = counted.groupBy("i", "part").agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")).collect()
        parts = [sorted((r["part"], r["n"], r["a"], r["b"]) for r in found if r["i"] == i) for i in range(len(intervals))]
        for rank, (a, b, below) in at.items():
            if a < b:
                for _, size, first, last in parts[intervals.index((a, b))]:
                    if rank < below + size:
                        at[rank] = (first, last, below)
                        break
                    below += size
    out = []
    for place in places:
        left, right = at[math.floor(place)][0], at[math.ceil(place)][0]
        out.append(left + (right - left) * (place - math.floor(place)))
    return out
