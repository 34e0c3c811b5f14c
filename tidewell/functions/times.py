"""Calendar expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def epoch_date(seconds: Column, tz: str) -> Column:
    """Calendar date in ``tz`` of an epoch-seconds value."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    in_utc = start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), in_utc))
