"""``python -m tidegate.demo VENUES.csv``: two runs over generated counts, three days apart, and what they left."""

from __future__ import annotations

import contextlib
import sys
import tempfile
import uuid
from datetime import date

from pyspark.sql import SparkSession

from tidegate.plans import reports
from tidegate.plans.engine import run
from tidegate.plans.warehouse import Warehouse
from tidegate.schema import RunSummary
from tidegate.session import get_spark
from tidegate.sources.dimension import read_venues
from tidegate.sources.items import synthetic

RUNS = (("first sight", date(2026, 3, 1)), ("three days later", date(2026, 3, 4)))


def demo(spark: SparkSession, venues: str, folder: str) -> tuple[list[RunSummary], int, int]:
    """The runs' summaries, rows stored, and (venue, day) pairs stored twice."""
    w = Warehouse(spark, folder)
    summaries = [run(w, read_venues(venues), today=day, backfill_days=90, chunk_days=30, source=synthetic) for _, day in RUNS]
    rows = w.read("pageviews")
    return summaries, rows.count(), reports.duplicate_pairs(rows, "venue_id", "view_date").first().duplicates


def main() -> None:
    spark = get_spark()
    given = sys.argv[2] if len(sys.argv) > 2 else spark.conf.get("spark.checkpoint.dir", None)
    if given is None and not spark.sparkContext.master.startswith("local"):
        raise SystemExit("name a folder that all executors share")
    with contextlib.nullcontext(f"{given}/demo-{uuid.uuid4().hex}") if given else tempfile.TemporaryDirectory() as folder:
        summaries, total, twice = demo(spark, sys.argv[1], folder)
        for (label, _), s in zip(RUNS, summaries, strict=True):
            print(f"{label:18} {s.status:7} requests={s.requests} fetched={s.rows_fetched} loaded={s.rows_loaded} quarantined={s.rows_quarantined}")
        print(f"{total} rows, {twice} (venue, day) pairs stored twice")
        reports.venue_profile(Warehouse(spark, folder).read("pageviews")).orderBy("mean_views", ascending=False).show(truncate=False)


if __name__ == "__main__":
    main()
