"""Reports over the warehouse's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.gate import reject_month


def venue_profile(rows: DataFrame) -> DataFrame:
    """Per venue: days, mean views rounded, first and last day."""
    return rows.groupBy("venue_id").agg(F.count(F.lit(1)).alias("days"), F.round(F.avg("views")).alias("mean_views"), F.min("view_date").alias("first_day"), F.max("view_date").alias("last_day"))


def duplicate_pairs(rows: DataFrame, *key: str) -> DataFrame:
    """One row: how many keys stand more than once."""
    return rows.groupBy(*key).count().where("count > 1").agg(F.count(F.lit(1)).alias("duplicates"))


def quarantine_report(rejects: DataFrame) -> DataFrame:
    """Per rule: distinct (venue, day) pairs, a null day counting too, and rows."""
    return rejects.groupBy("rule").agg(F.countDistinct(F.struct("venue_id", "view_date")).alias("days"), F.count(F.lit(1)).alias("rejections"))


def recent_runs(run_log: DataFrame, n: int = 10) -> DataFrame:
    return run_log.orderBy(F.desc("started_at"), "run_id").limit(n)


def stuck_venues(watermark: DataFrame) -> DataFrame:
    """Watermarks, the furthest behind first."""
    return watermark.orderBy("last_date", "venue_id")


def judged_counters(end: Column) -> dict[str, Column]:
    """Aggregates over judged rows, to be observed as they are written: rows_fetched, rows_quarantined, last_clean, the newest clean day up to ``end``, and reject_months, as ``reject_month`` tells them."""
    clean = F.col("rule").isNull()
    return {
        "rows_fetched": F.count(F.lit(1)),
        "rows_quarantined": F.count_if(~clean),
        "last_clean": F.max(F.when(clean & (F.col("view_date") <= end), F.col("view_date"))),
        "reject_months": F.collect_set(F.when(~clean, reject_month(F.col("view_date")))),
    }


def fetch_counters() -> dict[str, Column]:
    """Aggregates over staged items: failed, the first item in order of seq that is an error instead of an answer; null if none is."""
    return {"failed": F.min(F.when(F.col("error_type").isNotNull(), F.struct("seq", "error_type", "error")))}


def _listed(notes: str, order: str = "ord") -> Column:
    """Notes in order, with semicolons between; empty if there are none."""
    return F.coalesce(F.expr(f"listagg({notes}, '; ') WITHIN GROUP (ORDER BY {order})"), F.lit(""))


def stalled_note(plan: DataFrame) -> DataFrame:
    """One row: stalled, the venues that gave up days to the lookback limit, in the order of the list."""
    note = F.when(F.col("gave_up") > 0, F.concat("venue_id", F.lit(": gave up on "), F.col("gave_up").cast("string"), F.lit(" days")))
    return plan.withColumn("note__", note).agg(_listed("note__").alias("stalled"))


def run_report(per: DataFrame) -> DataFrame:
    """One row of what a run's venues (one row each) come to: its counters, and its notes in the order of the list.

    per has venue_id, ord, n_clean, n_bad, seen, fresh, held, new, alert. silent:
    alerts. known: how many rejects were known already. held_note: venues held.
    """
    n = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    free = ~F.col("held")
    text = lambda c: F.col(c).cast("string")
    held = F.when(F.col("held"), F.concat("venue_id", F.lit(": "), text("fresh"), F.lit("/"), text("seen"), F.lit(" newly rejected, above the ceiling, held")))
    r = per.withColumn("held__", held).agg(
        n("seen").alias("rows_fetched"),
        n("n_bad").alias("rows_quarantined"),
        n("fresh").alias("novel"),
        n(F.when(free, F.col("n_clean"))).alias("rows_loaded"),
        n(F.when(F.col("seen") > 0, 1)).alias("answering"),
        n(F.when(F.col("held"), 1)).alias("n_held"),
        n(F.when(free, F.col("seen"))).alias("gate_seen"),
        n(F.when(free, F.col("fresh"))).alias("gate_fresh"),
        n(F.when(free & F.col("new").isNotNull(), 1)).alias("marks"),
        _listed("alert").alias("silent"),
        _listed("held__").alias("held_note"),
    )
    m = text("rows_quarantined")
    known = F.concat((F.col("rows_quarantined") - F.col("novel")).cast("string"), F.lit(" of "), m, F.lit(" rejected rows were already quarantined; gate saw "), text("novel"))
    return r.withColumn("known", F.when(F.col("novel") != F.col("rows_quarantined"), known).otherwise(""))


def run_note(stalled: DataFrame, report: DataFrame) -> DataFrame:
    """One row: note, all of a run's notes in their order."""
    parts = F.filter(F.array("stalled", "silent", "known", "held_note"), lambda x: x != "")
    return stalled.crossJoin(report).select(F.array_join(parts, "; ").alias("note"))  # single rows


def totals(rows: DataFrame, *key: str) -> DataFrame:
    """One row: total rows, and duplicates, the keys that stand more than once."""
    per = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count_if(F.col("n") > 1).alias("duplicates"))


def reject_breadth(rejects: DataFrame) -> DataFrame:
    """Per rule: how many venues and how many days it has hit."""
    return rejects.groupBy("rule").agg(F.countDistinct("venue_id").alias("venues"), F.countDistinct("view_date").alias("days"))
