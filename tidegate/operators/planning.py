"""Which days to ask for: from watermarks to request windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def start_date(watermark: Column, has_rows: Column, end: Column, backfill_days: int) -> Column:
    """The first day to ask for.

    Without a watermark the backfill's first day; after one the day behind it.
    A watermark of a venue that never stored a row proves nothing: the earlier
    of both.
    """
    backfill = F.date_sub(end, backfill_days - 1)
    after = F.date_add(watermark, 1)
    return F.when(watermark.isNull(), backfill).when(~has_rows, F.least(after, backfill)).otherwise(after)


def plan_starts(venues: DataFrame, watermark: DataFrame, stored: DataFrame, end: Column, floor: Column, backfill_days: int) -> DataFrame:
    """venues with current (watermark), has_rows, start, gave_up (days skipped by the lookback limit).

    stored: any frame with venue_id, one row or more for venues with rows.
    """
    have = stored.select("venue_id").distinct().withColumn("has_rows", F.lit(True))
    p = venues.join(watermark.select("venue_id", F.col("last_date").alias("current")), "venue_id", "left").join(have, "venue_id", "left")
    p = p.withColumn("has_rows", F.coalesce("has_rows", F.lit(False)))
    p = p.withColumn("asked", start_date(F.col("current"), F.col("has_rows"), end, backfill_days))
    return p.withColumn("gave_up", F.greatest(F.datediff(floor, F.col("asked")), F.lit(0))).withColumn("start", F.greatest("asked", floor)).drop("asked")


def plan_windows(ranges: DataFrame, chunk_days: int, start: str = "start", end: str = "end") -> DataFrame:
    """Tiles [start, end] into windows of at most chunk_days: window_no, window_start, window_end. Empty ranges give none."""
    if chunk_days < 1:
        raise ValueError(f"chunk_days must be at least 1, not {chunk_days}")
    # sequence() counts down when the end comes first: such ranges go before
    steps = F.sequence(F.col(start), F.col(end), F.make_dt_interval(F.lit(chunk_days)))
    w = ranges.where(F.col(start) <= F.col(end)).select("*", F.posexplode(steps).alias("window_no", "window_start"))
    return w.withColumn("window_end", F.least(F.date_add("window_start", chunk_days - 1), F.col(end)))
