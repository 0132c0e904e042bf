"""Verification of empty answers as a plan: which questions a window takes, and which days they bring.

An empty answer is not believed at once: earlier starts are asked, one pad after
the other until one brings a day of the window, and halves of the window, and
halves of halves that are empty. What an upstream would answer is a frame of
records: (article, day, hidden_from, hidden_to), one or more for a day, each
shown by every question that covers the day but those of hidden_from to
hidden_to days; nulls hide nothing.

The whole tree of a window is unfolded in one expression, level by level, as
many as its length has halvings. A recursive CTE would say the same, but runs a
job for each level and ends at a million rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schema

DIRECT, WIDENED, SLICE = "direct", "widened", "slice"


def _visible(x: Column, days: Column) -> Column:
    return ~F.coalesce(days.between(x["hidden_from"], x["hidden_to"]), F.lit(False))


def covers(ask: Column, x: Column) -> Column:
    """Does the answer to ``ask`` show the record ``x``?"""
    return x["at"].between(ask["lo"], ask["hi"]) & _visible(x, ask["hi"] - ask["lo"] + 1)


def _ask(kind: str, lo: Column, hi: Column, records: Column) -> Column:
    """A question for the days lo to hi, counted from the window's first, and how many of the window's days it shows."""
    bare = F.struct(lo.alias("lo"), hi.alias("hi"))
    shown = F.size(F.array_distinct(F.transform(F.filter(records, lambda x: covers(bare, x)), lambda x: x["at"])))
    return F.struct(F.lit(kind).alias("kind"), lo.alias("lo"), hi.alias("hi"), shown.alias("n_days"))


def _slices(n: Column, records: Column) -> Column:
    """Halves, and halves of empty halves, down to single days, from left to right, the wider first."""

    def halves(a: Column) -> Column:
        cut = a["lo"] + F.floor((a["hi"] - a["lo"] + 1) / 2).cast("int")
        return F.array(_ask(SLICE, a["lo"], cut - 1, records), _ask(SLICE, cut, a["hi"], records))

    def deeper(acc: Column, _: Column) -> Column:
        empty = F.filter(acc["last"], lambda a: (a["n_days"] == 0) & (a["hi"] > a["lo"]))
        # bound once, as it is looked at twice
        found = F.array(F.flatten(F.transform(empty, halves)))
        return F.get(F.transform(found, lambda f: F.struct(F.concat(acc["every"], f).alias("every"), f.alias("last"))), F.lit(0))

    window = F.array(F.struct(F.lit(SLICE).alias("kind"), F.lit(0).alias("lo"), (n - 1).alias("hi"), F.lit(0).alias("n_days")))
    start = F.struct(F.slice(window, 1, 0).alias("every"), window.alias("last"))
    levels = F.when(n > 1, F.sequence(F.lit(1), F.ceil(F.log2(n.cast("double"))).cast("int"))).otherwise(F.array().cast("array<int>"))
    # depth first is by first day, wider before narrower
    every = F.transform(F.aggregate(levels, start, deeper)["every"], lambda a: F.struct(a["lo"].alias("lo"), (-a["hi"]).alias("neg"), a.alias("ask")))
    return F.transform(F.array_sort(every), lambda s: s["ask"])


def verified(windows: DataFrame, records: DataFrame, pads: tuple[int, ...] = schema.VERIFY_PADS) -> DataFrame:
    """windows with records__ (at, hidden_from, hidden_to) and asks__ (kind, lo, hi, n_days), in order.

    windows: article, window_start, window_end and further columns; equal rows
    are one. Windows that lack a day, or end before they start, ask nothing.
    A row holds its window's days only, each with the distinct ways in which
    it is hidden. Two shuffles: records meet windows by article and day, so
    that no article is one task's, and days meet their windows.
    """
    whole = windows.columns
    known = records.select("article", F.col("day").alias("day__"), F.struct(F.col("hidden_from").cast("int").alias("hidden_from"), F.col("hidden_to").cast("int").alias("hidden_to")).alias("how__")).where("day__ is not null").distinct()
    days = windows.withColumn("day__", F.explode_outer(F.when(F.col("window_start") <= F.col("window_end"), F.sequence("window_start", "window_end"))))
    at = F.datediff("day__", "window_start").alias("at")
    record = F.when(F.col("how__").isNotNull(), F.struct(at, F.col("how__.hidden_from").alias("hidden_from"), F.col("how__.hidden_to").alias("hidden_to")))
    met = days.join(known, ["article", "day__"], "left").groupBy(*whole).agg(F.collect_set(record).alias("records__"))
    n = F.datediff("window_end", "window_start") + 1
    met = met.withColumn("n__", n).withColumn("direct__", _ask(DIRECT, F.lit(0), F.col("n__") - 1, F.col("records__")))
    empty, none = F.col("direct__.n_days") == 0, F.expr("array()")
    asks, wanted = [F.array("direct__")], empty
    for i, pad in enumerate(pads):
        met = met.withColumn(f"pad{i}__", _ask(WIDENED, F.lit(-pad), F.col("n__") - 1, F.col("records__")))
        asks.append(F.when(wanted, F.array(f"pad{i}__")).otherwise(none))
        wanted = wanted & (F.col(f"pad{i}__.n_days") == 0)
    asks.append(F.when(empty, _slices(F.col("n__"), F.col("records__"))).otherwise(none))
    return met.select(*whole, "records__", F.when(F.col("n__") > 0, F.concat(*asks)).alias("asks__"))


def requests(checked: DataFrame) -> DataFrame:
    """One row for each question of ``verified``: ask_no from 0, kind, ask_start, ask_end, n_days (days of the window in its answer)."""
    rest = [c for c in checked.columns if c not in ("records__", "asks__")]
    day = lambda c: F.date_add("window_start", F.col(f"ask__.{c}"))
    told = checked.select(*rest, F.posexplode("asks__").alias("ask_no", "ask__"))
    return told.select(*rest, "ask_no", F.col("ask__.kind").alias("kind"), day("lo").alias("ask_start"), day("hi").alias("ask_end"), F.col("ask__.n_days").alias("n_days"))


def found_days(checked: DataFrame) -> DataFrame:
    """The days that the questions bring: day, kind and asked_days (the length of the first question that shows it).

    A wider answer's days stand before a slice's. Of a day the records that a
    question of asked_days days shows are the ones that it brings.
    """
    rest = [c for c in checked.columns if c not in ("records__", "asks__")]
    first = lambda x: F.get(F.filter("asks__", lambda a: covers(a, x)), F.lit(0))
    each = F.transform("records__", lambda x: F.struct(x["at"].alias("at"), first(x).alias("ask")))
    # a day's records may be shown by different questions: the earliest counts, and wider ones come first
    order = F.when(F.col("d__.ask.kind") == SLICE, 1).otherwise(0)
    got = checked.select(*rest, F.explode(each).alias("d__")).where("d__.ask is not null")
    got = got.select(*rest, F.date_add("window_start", F.col("d__.at")).alias("day"), F.col("d__.ask.kind").alias("kind"), (F.col("d__.ask.hi") - F.col("d__.ask.lo") + 1).alias("asked_days"), order.alias("order__"))
    return got.groupBy(*rest, "day").agg(F.min_by(F.struct("kind", "asked_days"), "order__").alias("by__")).select(*rest, "day", "by__.kind", "by__.asked_days")
