"""Positions in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.session import materialize


def dense_ordinals(rows: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """``rows`` with their places 1, 2, ... in ``order``, as ``row_number`` over all rows would give them.

    Rows are dealt to ranges and sorted there; a range starts after the rows of those before it. Only the table
    of ranges passes one task. Rows that ``order`` can't tell apart share a range, so end it with a key; they are numbered anyhow.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # the partition above the 33 bits of the place in it
    stored = materialize(
        dealt.select(F.struct("*").alias("row"), F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at")),
        "ordinals",
    )
    sizes = stored.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", before.alias("start"))  # one row per range
    return stored.join(starts, "part").select("row.*", (F.col("start") + F.col("at") + 1).alias(name))
