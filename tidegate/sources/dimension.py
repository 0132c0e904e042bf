"""The venue list: a hand-edited CSV, read on the driver and checked line by line."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidegate.functions.scalars import nfc
from tidegate.schema import VENUE_COLUMNS, VENUES, Venue


def read_venues(path: str | Path) -> list[Venue]:
    """Venues in order. Raises ValueError, naming the line, for a list that can't be meant.

    A byte order mark, extra columns and blank headers are allowed; fields are
    stripped of all white space; titles, not ids, are brought to NFC.
    """
    text = Path(path).read_bytes().decode("utf-8-sig")
    rows = csv.reader(io.StringIO(text, newline=""))
    header = next(rows, [])
    if absent := [c for c in VENUE_COLUMNS if c not in header]:
        raise ValueError(f"{path}: no column {absent} among {header}")
    if twice := [c for c in sorted(VENUE_COLUMNS) if header.count(c) > 1]:
        raise ValueError(f"{path}: column {twice} stands more than once in {header}")
    at = {c: header.index(c) for c in VENUE_COLUMNS}
    lines: dict[str, int] = {}
    out: list[Venue] = []
    line = 1
    for row in rows:
        if not row:
            continue
        line += 1
        got = {c: row[i].strip() if i < len(row) else "" for c, i in at.items()}
        got["wiki_article"] = nfc(got["wiki_article"])
        if empty := [c for c in VENUE_COLUMNS if not got[c]]:
            raise ValueError(f"{path} line {line}: nothing in {empty}")
        if (venue_id := got["venue_id"]) in lines:
            raise ValueError(f"{path} line {line}: venue_id {venue_id!r} was used on line {lines[venue_id]}")
        lines[venue_id] = line
        out.append(Venue(**got))
    if not out:
        raise ValueError(f"{path}: no venues")
    return out


def venues_frame(spark: SparkSession, venues: Iterable[Venue]) -> DataFrame:
    """Venues with ord, their place in the list."""
    rows = [(v.venue_id, v.venue_name, v.region, v.wiki_article, i) for i, v in enumerate(venues)]
    return spark.createDataFrame(rows, VENUES)
