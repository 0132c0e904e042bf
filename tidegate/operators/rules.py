"""Row rules: each item is clean, or named by the first rule it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegate import schema
from tidegate.functions.scalars import is_ascii, kind_of, looks_alike, parse_stamp, same_nfc

_PYTHON = {"null": "NoneType", "str": "str", "bool": "bool", "float": "float", "list": "list", "dict": "dict"}


def _quoted(c: Column) -> Column:
    return F.concat(F.lit("'"), c, F.lit("'"))


def _escaped(c: Column) -> Column:
    """Non-ASCII characters as \\uXXXX, so that look-alikes can be told apart."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    one = lambda x: F.when(is_ascii(x), x).otherwise(F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(F.encode(x, "UTF-16BE"))), 4, "0")))
    return F.array_join(F.transform(chars, one), "")


def judge(items: DataFrame, today: Column, by_day: str | None = "window_start") -> DataFrame:
    """items with view_date, views, rule, detail; rule is null for clean rows.

    Needs venue_id, article, window_start, window_end, seq and raw. A day's
    first row in order of seq stays, among rows clean by all other rules and of
    the same venue and window; later ones break one_row_per_date, which with
    by_day None isn't looked at. view_date is
    the row's day whatever rule it breaks, null if it has none.
    """
    raw = F.col("raw")
    # the text is parsed twice: for the values' kinds, and for their spelling
    j = items.withColumn("v__", F.try_parse_json(raw)).withColumn("f__", F.from_json(raw, "article string, timestamp string, views string"))
    j = j.select("*", F.col("f__.article").alias("got__"), F.col("f__.timestamp").alias("stamp__"), F.col("f__.views").alias("count__"))
    kind = lambda field, text: kind_of(F.try_variant_get("v__", f"$.{field}", "variant"), F.col(text))
    j = j.withColumn("kind__", kind("views", "count__")).withColumn("is_title__", F.coalesce(kind("article", "got__") == "str", F.lit(False)))
    j = j.withColumn("view_date", parse_stamp(F.when(kind("timestamp", "stamp__") == "str", F.col("stamp__")))).drop("v__", "f__")
    # few rows, if any, need Python: they take a way of their own, and all others stay in the JVM
    got, asked = F.col("got__"), F.col("article")
    hard = F.col("is_title__") & looks_alike(got, asked)
    easy = j.where(~hard).withColumn("same__", F.coalesce(F.col("is_title__") & (got == asked), F.lit(False)))
    j = easy.unionByName(j.where(hard).withColumn("same__", F.coalesce(same_nfc(got, asked), F.lit(False))))
    return first_broken_rule(j, F.col("same__"), F.col("stamp__"), F.col("kind__"), F.col("count__"), today, got=F.col("got__"), by_day=by_day).drop("got__", "stamp__", "count__", "kind__", "is_title__", "same__")


def first_broken_rule(j: DataFrame, same: Column, stamp: Column, kind: Column, count: Column, today: Column, got: Column | None = None, by_day: str | None = "window_start") -> DataFrame:
    """The rules over columns already taken apart; j has view_date. Adds views, rule, detail.

    kind is the count's JSON kind, count its spelling.
    """
    got = got if got is not None else F.lit(None).cast("string")
    day, start, end = F.col("view_date"), F.col("window_start"), F.col("window_end")
    negative = count.startswith("-") & F.regexp_like(count, F.lit("[1-9]"))
    number = F.when(kind == "int", count.try_cast("bigint"))
    nth = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    rule = (
        F.when(~same, schema.RULES[0])
        .when(day.isNull(), schema.RULES[1])
        .when(~day.between(start, end), schema.RULES[2])
        .when(day > today, schema.RULES[3])
        .when(F.coalesce(kind, F.lit("null")) != "int", schema.RULES[4])
        .when(negative, schema.RULES[5])
        .when(number.isNull(), schema.RULES[6])
    )
    names = F.create_map(*[F.lit(x) for kv in _PYTHON.items() for x in kv])
    plain = F.concat(F.lit("got "), F.coalesce(_quoted(got), F.lit("None")), F.lit(", asked for "), _quoted(F.col("article")))
    escaped = F.concat(plain, F.lit(" ("), _escaped(got), F.lit(" vs "), _escaped(F.col("article")), F.lit(")"))
    detail = (
        F.when(rule == schema.RULES[0], F.when(got.isNull() | (is_ascii(got) & is_ascii(F.col("article"))), plain).otherwise(escaped))
        .when(rule == schema.RULES[1], F.concat(F.lit("expected a daily stamp YYYYMMDD00, got "), F.coalesce(_quoted(stamp), F.lit("None"))))
        .when(rule == schema.RULES[2], F.concat(nth(day), F.lit(" outside "), nth(start), F.lit(".."), nth(end)))
        .when(rule == schema.RULES[3], F.concat(nth(day), F.lit(" is after "), nth(today)))
        .when(rule == schema.RULES[4], F.concat(F.lit("got "), F.coalesce(F.element_at(names, kind), F.lit("NoneType")), F.lit(" "), F.when(kind == "str", _quoted(count)).otherwise(nth(count))))
        .when(rule == schema.RULES[5], F.concat(F.lit("got "), count))
        .when(rule == schema.RULES[6], F.concat(F.lit("got "), count, F.lit(f", above the {schema.VIEWS_MAX} that the column holds")))
    )
    j = j.withColumn("rule", rule).withColumn("detail", detail).withColumn("views", F.when(rule.isNull(), number))
    return one_row_per_date(j, by_day) if by_day else j


def seen_before(day: object, views: int) -> str:
    """The detail of a row whose day stands already, as one_row_per_date words it."""
    return f"{day} already seen with {views} views"


def one_row_per_date(j: DataFrame, by_day: str = "window_start") -> DataFrame:
    """Of clean rows (rule null) of one venue, window and day the first by seq stays clean."""
    # rows already rejected stand in partitions of their own, spread by seq; a
    # column, so that both functions share one window and one exchange
    j = j.withColumn("other__", F.when(F.col("rule").isNotNull(), F.col("seq")))
    w = Window.partitionBy("venue_id", by_day, "view_date", "other__").orderBy("seq")
    j = j.select("*", F.row_number().over(w).alias("nth__"), F.first("views").over(w).alias("first__"))
    late = F.col("rule").isNull() & (F.col("nth__") > 1)
    j = j.withColumns(
        {
            "detail": F.when(late, F.concat(F.col("view_date").cast("string"), F.lit(" already seen with "), F.col("first__").cast("string"), F.lit(" views"))).otherwise(F.col("detail")),
            "views": F.when(~late, F.col("views")),
            "rule": F.when(late, schema.RULES[7]).otherwise(F.col("rule")),
        }
    )
    return j.drop("other__", "nth__", "first__")
