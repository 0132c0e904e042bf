"""The payload contract over frames of raw bodies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schema

_NAMES = {"VOID": "NoneType", "STRING": "str", "BOOLEAN": "bool"}


def _kind(v: Column, text: Column) -> Column:
    """The kind of a value; its spelling tells integers from other numbers."""
    k = F.schema_of_variant(v)
    out = F.when(k.startswith("ARRAY"), "list").when(k.startswith("OBJECT"), "dict")
    for spark_name, name in _NAMES.items():
        out = out.when(k == spark_name, name)
    return out.when(F.regexp_like(text, F.lit(r"\A\s*-?[0-9]+\s*\z")), "int").otherwise("float")


def _bound(df: DataFrame, **cols: Column) -> DataFrame:
    """df with ``cols``, each worked out once a row: behind explode() no filter or projection takes them up again."""
    made = df.select("*", F.explode(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))).alias("bound__"))
    return made.select(*df.columns, *[F.col(f"bound__.{n}").alias(n) for n in cols])


def parse_bodies(responses: DataFrame, body: str = "body", article: str = "article") -> tuple[DataFrame, DataFrame]:
    """(items, drift) of 200 answers.

    items: the responses' other columns with pos and raw (an item's JSON text).
    drift: those columns with pos and message, one row for each departure;
    body-level ones have pos -1. A caller that finds any must load nothing of
    the run; the first by its own order and pos is the one to report.
    """
    keep = [c for c in responses.columns if c != body]
    whole = F.col(body).cast("string")
    r = _bound(responses, text__=F.when(F.is_valid_utf8(whole), whole))
    r = _bound(r, v__=F.try_parse_json("text__"))
    r = _bound(r, items__=F.try_variant_get("v__", "$.items", "variant"))
    text, items = F.col("text__"), F.col("items__")
    kind = F.schema_of_variant(items)
    wrong = (
        F.when(F.col("v__").isNull(), "the body is no UTF-8 JSON")
        .when(~F.schema_of_variant("v__").startswith("OBJECT"), F.concat(F.lit("the body is "), _kind(F.col("v__"), text), F.lit(", not an object")))
        .when(kind.isNull() | (kind == "VOID"), "the body has no 'items'")
        .when(~kind.startswith("ARRAY"), F.concat(F.lit("'items' is "), _kind(items, F.get_json_object("text__", "$.items")), F.lit(", not a list")))
    )
    r = _bound(r, wrong__=wrong)
    # an item's text is kept as it came; its kind is told apart from the text, as a string may hold an object's
    ok = _bound(r.where("wrong__ is null"), listed__=F.get_json_object("text__", "$.items"))
    listed = F.col("listed__")
    both = F.arrays_zip(F.from_json(listed, "array<string>").alias("raw"), F.from_json(listed, "array<variant>").alias("v"))
    ok = ok.select(*keep, F.posexplode(both).alias("pos", "item__")).select(*keep, "pos", F.col("item__.raw").alias("raw"), F.col("item__.v").alias("v__"))
    kind = F.when(F.col("raw").isNull(), "NoneType").otherwise(_kind(F.col("v__"), F.col("raw")))
    shape = F.when(kind != "dict", F.concat(F.lit("an item is "), kind, F.lit(", not an object")))
    judged = _bound(ok, message=F.coalesce(shape, item_drift(F.col("raw"))))
    told = lambda df, pos: df.select(*keep, pos.cast("int").alias("pos"), F.concat(F.col(article), F.lit(": "), F.col("message")).alias("message"))
    drift = told(r.where("wrong__ is not null").withColumn("message", F.col("wrong__")), F.lit(-1)).union(told(judged.where("message is not null"), F.col("pos")))
    return judged.where("message is null").select(*keep, "pos", "raw"), drift


def item_drift(raw: Column) -> Column:
    """How an item departs from the contract, or null. The text is bound once, whatever expression it is."""
    return F.get(F.transform(F.array(raw), _item_drift), F.lit(0))


def _item_drift(raw: Column) -> Column:
    keys = F.json_object_keys(raw)
    missing = F.array_join(F.array_except(F.lit(sorted(schema.FIELDS)), keys), "', '")
    out = F.when(keys.isNull(), F.concat(F.lit("an item is "), F.coalesce(_kind(F.try_parse_json(raw), raw), F.lit("NoneType")), F.lit(", not an object")))
    out = out.when(missing != "", F.concat(F.lit("an item has no ['"), missing, F.lit("']")))
    for name, value in schema.DESCRIPTORS:
        # no value but this string is spelled so
        text = F.coalesce(F.get_json_object(raw, f"$.{name}"), F.lit("None"))
        out = out.when(text != value, F.concat(F.lit(f"{name} is "), text, F.lit(f", not '{value}': this answers another question")))
    stamp = F.try_variant_get(F.try_parse_json(raw), "$.timestamp", "variant")
    return out.when(F.coalesce(F.schema_of_variant(stamp), F.lit("VOID")) != "STRING", F.concat(F.lit("timestamp is "), _kind(stamp, F.get_json_object(raw, "$.timestamp")), F.lit(", not a string")))
