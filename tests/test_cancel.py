"""A run told to stop: nothing committed, nothing staged, nothing running."""

import glob
import threading
import time
from datetime import date, timedelta

import pytest

from tidegate.plans.cancel import Cancellation
from tidegate.plans.engine import run
from tidegate.plans.warehouse import Warehouse
from tidegate.schema import RunCancelled, Venue
from tidegate.sources import items

VENUES = [Venue(x, x, "r", x) for x in ("a", "b")]
DAY = date(2026, 3, 1)


def _in_thread(w, cancellation, source):
    came = []

    def go():
        try:
            came.append(run(w, VENUES, today=DAY, backfill_days=5, source=source, cancellation=cancellation))
        except BaseException as e:
            came.append(e)

    from pyspark import InheritableThread

    t = InheritableThread(target=go)
    t.daemon = True
    t.start()
    return t, came


def _nothing(w, before, cancellation):
    assert w.manifest() == before
    assert w.read("run_log").count() == 0
    assert not [f for f in glob.glob(f"{w.path}/_staging/**", recursive=True) if f.endswith(".parquet")]
    assert cancellation.running_tasks() == 0


def test_cancelled_while_fetching(spark, tmp_path):
    w, c, began = Warehouse(spark, str(tmp_path / "w")), Cancellation(spark), tmp_path / "began"
    before, path = w.manifest(), str(began)

    def slow(article, start, end):
        open(path, "w").close()
        time.sleep(120)
        return []

    t, came = _in_thread(w, c, items.OnExecutors(slow))
    until = time.monotonic() + 60
    while not began.exists() and time.monotonic() < until:
        time.sleep(0.1)
    c.cancel()
    t.join(100)
    assert began.exists() and not t.is_alive()
    assert isinstance(came[0], RunCancelled)
    _nothing(w, before, c)
    # the warehouse is as good as before, and other jobs of the session go on
    assert run(w, VENUES, today=DAY, backfill_days=5, source=items.synthetic).status == "ok"


def test_cancelled_between_jobs(spark, tmp_path):
    w, c = Warehouse(spark, str(tmp_path / "w")), Cancellation(spark)
    before = w.manifest()

    def source(windows):
        c.cancel()
        return items.synthetic(windows)

    with pytest.raises(RunCancelled):
        run(w, VENUES, today=DAY, backfill_days=5, source=source, cancellation=c)
    _nothing(w, before, c)


def test_cancelled_before_it_begins_and_after_it_ended(spark, tmp_path):
    w, c = Warehouse(spark, str(tmp_path / "w")), Cancellation(spark)
    assert run(w, VENUES, today=DAY, backfill_days=5, source=items.synthetic, cancellation=c).status == "ok"
    c.cancel()
    assert w.read("run_log").count() == 1
    with pytest.raises(RunCancelled):
        run(w, VENUES, today=DAY + timedelta(days=1), source=items.synthetic, cancellation=c)
    assert w.read("run_log").count() == 1
    assert spark.range(3).count() == 3


def test_only_its_own_jobs_are_stopped(spark, tmp_path):
    w, c, other = Warehouse(spark, str(tmp_path / "w")), Cancellation(spark), Cancellation(spark)
    other.cancel()
    assert run(w, VENUES, today=DAY, backfill_days=5, source=items.synthetic, cancellation=c).status == "ok"
