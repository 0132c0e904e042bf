"""How far watermarks may go, and which venues have gone quiet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def days_by_month(rows: DataFrame, *also: str) -> DataFrame:
    """Per venue and month of stored rows: first (the month's first day) and days, a bit for each day that has a row.

    Of two sets of rows the months go together by bit_or; a month that is written
    anew has its row anew. A plan, an alert and the frontier need no more of the
    counts, and a year of a venue is 12 rows. also: columns that follow from venue
    and day's month, kept.
    """
    day = F.expr("shiftleft(1L, day(view_date) - 1)")
    return rows.groupBy("venue_id", F.trunc("view_date", "month").alias("first"), *also).agg(F.bit_or(day).alias("days"))


def stored_history(months: DataFrame, end: Column) -> DataFrame:
    """Per venue of ``days_by_month``: last_stored, its newest day, and last_due, the newest up to ``end``."""
    within = F.least(F.greatest(F.datediff(end, "first") + 1, F.lit(0)), F.lit(31)).cast("int")
    due = F.col("days").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), within) - 1)
    newest = lambda bits: F.max(F.when(bits > 0, F.date_add("first", F.length(F.bin(bits)) - 1)))
    return months.groupBy("venue_id").agg(newest(F.col("days")).alias("last_stored"), newest(due).alias("last_due"))


def publication_frontier(stored: DataFrame, clean: DataFrame, end: Column) -> DataFrame:
    """One row: observed, the newest day up to ``end`` that any venue has, stored or in this run; null if none has."""
    best = lambda df: df.where(F.col("view_date") <= end).agg(F.max("view_date").alias("d"))
    return best(stored.select("view_date")).union(best(clean.select("view_date"))).agg(F.max("d").alias("observed"))


def trusted_end(observed: Column, trust_line: Column) -> Column:
    """The last day whose absence is believed. No evidence means null, which holds; it is not the trust line."""
    return F.when(observed.isNotNull(), F.least(observed, trust_line))


def venue_stats(judged: DataFrame, start: str = "venue_start", end: str = "venue_end") -> DataFrame:
    """Per venue: n_clean, n_bad, last_clean, first_bad (earliest rejected day of the venue's whole range), unknown_bad (a rejected row without a day)."""
    bad = F.col("rule").isNotNull()
    inside = bad & F.col("view_date").between(F.col(start), F.col(end))
    return judged.groupBy("venue_id").agg(
        F.count_if(~bad).alias("n_clean"),
        F.count_if(bad).alias("n_bad"),
        F.max(F.when(~bad, F.col("view_date"))).alias("last_clean"),
        F.min(F.when(inside, F.col("view_date"))).alias("first_bad"),
        F.coalesce(F.bool_or(bad & F.col("view_date").isNull()), F.lit(False)).alias("unknown_bad"),
    )


def venue_frontier(start: Column, end: Column, trusted: Column, last_clean: Column, first_bad: Column, unknown_bad: Column) -> Column:
    """The day up to which everything has been dealt with, or null to leave the watermark.

    A rejected day stops it the day before; one without a day stops it
    altogether. Absent days are passed up to the last day that arrived, or up to
    the trusted end.
    """
    ceiling = F.coalesce(F.date_sub(first_bad, 1), end)
    reach = F.when(trusted.isNull(), last_clean).otherwise(F.greatest(last_clean, F.least(end, trusted)))
    far = F.when(reach.isNotNull(), F.least(reach, ceiling))
    return F.when(~F.coalesce(unknown_bad, F.lit(False)) & (far >= start), far)


def advance(frontier: Column, current: Column) -> Column:
    """The new watermark, or null: never backwards."""
    return F.when(frontier.isNotNull() & (current.isNull() | (frontier > current)), frontier)


def alert(venue_id: Column, article: Column, ever: Column, n_clean: Column, n_bad: Column, last: Column, end: Column, effective: Column, trust_lag_days: int) -> Column:
    """A note on a venue that never had a row, or has had none for longer than the trust lag; else null.

    ever: has stored rows. last: its newest day, stored or of this run.
    """
    check = F.concat(F.lit(", check '"), article, F.lit("'"))
    rejected = F.when(n_bad > 0, F.concat(F.lit(", "), n_bad.cast("string"), F.lit(" row(s) rejected"))).otherwise("")
    days = F.datediff(end, last)
    return F.when(~ever & (n_clean == 0), F.concat(venue_id, F.lit(": no rows ever"), rejected, check)).when(
        days > trust_lag_days, F.concat(venue_id, F.lit(": no rows for "), days.cast("string"), F.lit(" days (watermark "), F.coalesce(effective.cast("string"), F.lit("None")), F.lit(")"), check)
    )
