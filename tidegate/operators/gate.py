"""What may load: novelty, held venues, and the majority that refuses a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalars import reject_rate
from tidegate.schema import QualityGateFailed

KEY = ("venue_id", "view_date", "rule")


def reject_month(view_date: Column) -> Column:
    """The month by which rejects are kept. Days outside this century, and absent ones, are under "none", as a reject's day may be anything."""
    return F.when(F.year(view_date).between(2000, 2099), F.date_format(view_date, "yyyy-MM")).otherwise("none")


def already(quarantine: DataFrame) -> DataFrame:
    return quarantine.select(*KEY).distinct()


def novel_rejects(bad: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Rejected rows not in quarantine for the same venue, day and rule; null days equal each other. Repeats within ``bad`` stay."""
    a, b = bad.alias("a"), already(quarantine).alias("b")
    on = F.lit(True)
    for k in KEY:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, on, "left_anti")


def held_venues(seen: DataFrame, novel: DataFrame, max_reject_rate: float) -> DataFrame:
    """seen (venue_id, seen) with fresh, rate and held: newly rejected above the ceiling, strictly."""
    fresh = novel.groupBy("venue_id").agg(F.count(F.lit(1)).alias("fresh"))
    out = seen.join(fresh, "venue_id", "left").withColumn("fresh", F.coalesce("fresh", F.lit(0)))
    out = out.withColumn("rate", reject_rate(F.col("fresh"), F.col("seen")))
    return out.withColumn("held", (F.col("seen") > 0) & (F.col("rate") > F.lit(float(max_reject_rate))))


def verdict(held: DataFrame) -> DataFrame:
    """One row: answering, n_held, majority; and rows seen and newly rejected of venues not held, with their rate."""
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    free: Column = ~F.col("held")
    v = held.agg(
        n(F.when(F.col("seen") > 0, 1)).alias("answering"),
        n(F.when(F.col("held"), 1)).alias("n_held"),
        n(F.when(free, F.col("seen"))).alias("gate_seen"),
        n(F.when(free, F.col("fresh"))).alias("gate_fresh"),
    )
    return v.withColumn("majority", (F.col("answering") > 0) & (2 * F.col("n_held") > F.col("answering"))).withColumn("gate_rate", reject_rate(F.col("gate_fresh"), F.col("gate_seen")))


def drop_held(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of venues that aren't held."""
    return rows.join(held.where("held").select("venue_id"), "venue_id", "left_anti")


def enforce_gate(fetched: int, rejected: int, max_reject_rate: float) -> float:
    """The rate of a run, or QualityGateFailed if it is above the ceiling."""
    rate = rejected / fetched if fetched else 0.0
    if rate > max_reject_rate:
        raise QualityGateFailed(f"{rejected} of {fetched} rows rejected ({rate:.2%}), more than {max_reject_rate:.2%}. Nothing was loaded.")
    return rate


def enforce_majority(answering: int, held: int, max_reject_rate: float) -> None:
    if answering and 2 * held > answering:
        raise QualityGateFailed(f"{held} of {answering} venues that answered rejected more than {max_reject_rate:.0%}: a bad extract, not {held} bad venues. Nothing was loaded.")
