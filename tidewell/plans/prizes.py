"""Prize money per draw, per winner and after tax."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.functions.scoring import after_tax, share_per_winner


def prize_series(draws: DataFrame, first: int | None = None, last: int | None = None) -> DataFrame:
    """(drwNo, date, winner, winmnt, permnt, relmnt) of the draws that had winners."""
    wanted = (F.col("returnValue") == "success") & (F.col("firstPrzwnerCo") != 0)
    if first is not None:
        wanted = wanted & (F.col("drwNo") >= first)
    if last is not None:
        wanted = wanted & (F.col("drwNo") <= last)
    return (
        draws.where(wanted)
        .select(
            "drwNo",
            F.col("drwNoDate").alias("date"),
            F.col("firstPrzwnerCo").alias("winner"),
            F.col("firstWinamnt").alias("winmnt"),
            share_per_winner(F.col("firstWinamnt"), F.col("firstPrzwnerCo")).alias("permnt"),
        )
        .withColumn("relmnt", after_tax(F.col("permnt")))
    )
