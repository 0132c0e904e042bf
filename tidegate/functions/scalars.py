"""Scalar expressions: titles, stamps, URLs, JSON kinds, rates."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate import schema


def nfc(title: str) -> str:
    return unicodedata.normalize("NFC", title)


def _same(got: pa.Scalar, asked: pa.Scalar) -> bool | None:
    """One pair of texts at a time becomes Python's; null if either is."""
    return nfc(got.as_py()) == nfc(asked.as_py()) if got.is_valid and asked.is_valid else None


@F.arrow_udf(T.BooleanType())
def _same_nfc(got: pa.Array, asked: pa.Array) -> pa.Array:
    return pa.array(map(_same, got, asked), pa.bool_())


def is_ascii(c: Column) -> Column:
    return F.regexp_like(c, F.lit(r"\A\p{ASCII}*\z"))


def looks_alike(got: Column, asked: Column) -> Column:
    """Titles that differ and aren't plain ASCII: only these may still be equal up to NFC."""
    return F.coalesce((got != asked) & ~(is_ascii(got) & is_ascii(asked)), F.lit(False))


def same_nfc(got: Column, asked: Column) -> Column:
    """Equality up to NFC, in Python: Spark has no normalize(), and its collations equate too much."""
    return _same_nfc(got, asked)


def same_title(got: Column, asked: Column) -> Column:
    """Equality up to NFC in one expression; Python sees titles only where they look alike."""
    hard = looks_alike(got, asked)
    return (got == asked) | F.coalesce(same_nfc(F.when(hard, got), F.when(hard, asked)), F.lit(False))


def parse_stamp(stamp: Column) -> Column:
    """The day of YYYYMMDD00, or null. ASCII digits only; a trailing newline is refused; years begin with 1."""
    well = F.regexp_like(stamp, F.lit(r"\A[0-9]{8}00\z")) & ~stamp.startswith("0000")
    return F.when(well, F.try_to_date(F.left(stamp, F.lit(8)), "yyyyMMdd"))


def in_days(stamp: Column, start: Column, end: Column) -> Column:
    """Does a stamp's text lie in the days asked for? One that doesn't begin with a day is kept, for the rules to judge."""
    day = F.left(stamp, F.lit(8))
    f = lambda d: F.date_format(d, "yyyyMMdd")
    return ~F.coalesce(F.regexp_like(day, F.lit(r"\A[0-9]{8}\z")), F.lit(False)) | day.between(f(start), f(end))


def url_quote(c: Column) -> Column:
    """Percent-encoding with nothing but unreserved characters left."""
    return F.replace(F.replace(F.replace(F.url_encode(c), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def build_url(article: Column, start: Column, end: Column) -> Column:
    """A window's request. Null if it starts after its end."""
    f = lambda d: F.date_format(d, "yyyyMMdd")
    return F.when(start <= end, F.concat_ws("/", F.lit(schema.API_ROOT), F.lit(schema.PROJECT), F.lit(schema.ACCESS), F.lit(schema.AGENT), url_quote(article), F.lit(schema.GRANULARITY), f(start), f(end)))


def json_kind(raw: Column, field: str) -> Column:
    """null, bool, int, float, str, list or dict; SQL null where the field is absent or the text isn't JSON.

    An int is an integer by its spelling: 120.0 and 1e2 are floats.
    """
    return kind_of(F.try_variant_get(F.try_parse_json(raw), f"$.{field}", "variant"), F.get_json_object(raw, f"$.{field}"))


def kind_of(value: Column, text: Column) -> Column:
    """json_kind of a value that is parsed already, and its spelling."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", "null")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "STRING", "str")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "dict")
        .when(kind.isNotNull() & F.regexp_like(text, F.lit(r"\A-?[0-9]+\z")), "int")
        .when(kind.isNotNull(), "float")
    )


def reject_rate(rejected: Column, seen: Column) -> Column:
    """0 of 0 is 0."""
    return F.coalesce(F.try_divide(rejected.cast("double"), seen.cast("double")), F.lit(0.0))


def backoff(attempt: Column, retry_after: Column, jitter: Column | None = None) -> Column:
    """Seconds to wait: the server's wish, if finite, within 0 and the limit; else 2^attempt and jitter."""
    most = F.lit(schema.MAX_BACKOFF_SECONDS)
    wish = retry_after.try_cast("double")
    finite = wish.isNotNull() & ~F.isnan(wish) & (F.abs(wish) < float("inf"))
    own = F.least(F.pow(F.lit(2.0), attempt.cast("double")) + (jitter if jitter is not None else F.lit(0.0)), most)
    return F.when(finite, F.greatest(F.least(wish, most), F.lit(0.0))).otherwise(own)
