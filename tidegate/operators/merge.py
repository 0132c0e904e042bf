"""Merging answers and upserting rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalars import in_days


def merge_sources(widened: DataFrame, slices: DataFrame, start: Column, end: Column, key: Sequence[str] = ()) -> DataFrame:
    """Widened rows, and those sliced rows whose stamp they don't have, trimmed to the days asked for.

    Needs stamp and pos. Frames that hold several requests need the ``key`` that
    tells them apart: a stamp covers only its own request's. Repeats within a
    source stay, in order (src, pos), for the rules to see. The order is a
    column pair, as frames have none.
    """
    on = [*key, "stamp"]
    w = widened.where(in_days(F.col("stamp"), start, end)).withColumn("src", F.lit(0))
    s = slices.where(in_days(F.col("stamp"), start, end)).withColumn("src", F.lit(1))
    return w.unionByName(s.join(w.select(on).distinct(), on, "left_anti").select(w.columns))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with new's rows in place of those of the same key. Keys of ``new`` must be unique."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)
