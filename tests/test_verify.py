"""Verification as a plan, against the client that asks one question after another."""

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators import verify
from tidegate.sources import items
from tidegate.sources.http import WindowClient

D = date(2026, 1, 5)
WINDOWS = "venue_id string, article string, venue_start date, venue_end date, window_start date, window_end date, call long"
RECORDS = "article string, day date, hidden_from int, hidden_to int, pos long, raw string"


def _raw(article, day, pos):
    values = {"project": schema.PROJECT, "article": article, "granularity": schema.GRANULARITY, "timestamp": f"{day:%Y%m%d}00", "access": schema.ACCESS, "agent": schema.AGENT, "views": pos}
    return json.dumps(values, ensure_ascii=False)


def _window(article, n, call=0, start=D):
    end = start + timedelta(days=n - 1)
    return (f"v{call}", article, start, end, start, end, call)


def _record(article, at, low, high, pos):
    day = D + timedelta(days=at)
    return (article, day, low, high, pos, _raw(article, day, pos))


def _by_client(window, records):
    """The questions in the client's order, and its items' texts."""
    asked = []

    def opener(url):
        a, b = (date(int(x[:4]), int(x[4:6]), int(x[6:])) for x in url.split("/")[-2:])
        asked.append((a, b))
        n = (b - a).days + 1
        hidden = lambda r: r[2] is not None and r[3] is not None and r[2] <= n <= r[3]
        got = sorted((r[1], r[4], r[5]) for r in records if r[0] == window[1] and a <= r[1] <= b and not hidden(r))
        return 200, {}, json.dumps({"items": [json.loads(x[2]) for x in got]}, ensure_ascii=False).encode()

    found = WindowClient(opener=opener).fetch(window[1], window[4], window[5])
    return asked, [json.dumps(i, ensure_ascii=False) for i in found]


def _by_plan(spark, windows, records):
    w, r = spark.createDataFrame(windows, WINDOWS), spark.createDataFrame(records, RECORDS)
    asks = {}
    for row in verify.requests(verify.verified(w, r)).orderBy("call", "ask_no").collect():
        asks.setdefault(row.call, []).append((row.ask_start, row.ask_end))
    got = {}
    for row in items.recorded(r)(w).orderBy("seq").collect():
        got.setdefault(row.seq // items.CALL, []).append(row.raw)
    return asks, got


def test_any_upstream_as_the_client_sees_it(spark):
    rnd = random.Random(7)
    windows, records = [], []
    for call in range(60):
        article, n = f"A{call}", rnd.choice([1, 2, 3, 5, 7, 8, 13, 16, 30])
        windows.append(_window(article, n, call))
        for pos in range(rnd.choice([0, 1, 4, 40])):
            low = rnd.choice([None, 1, 2, n, n, n + 1])
            high = rnd.choice([None, 1, 3, n, n + 15, n + 30, 1000])
            records.append(_record(article, rnd.randint(-32, n + 2), low, high, pos))
    asks, got = _by_plan(spark, windows, records)
    for w in windows:
        want_asks, want = _by_client(w, records)
        assert asks[w[6]] == want_asks
        assert got.get(w[6], []) == want


@pytest.mark.parametrize(
    ("n", "low", "high", "requests"),
    [(30, 1, 9999, 61), (1, 1, 9999, 3), (2, 1, 9999, 5), (30, 30, 30, 4), (30, 8, 9999, 13), (30, None, None, 1)],
)
def test_number_of_requests(spark, n, low, high, requests):
    window, records = _window("A", n), [_record("A", i, low, high, i) for i in range(n)]
    asks, got = _by_plan(spark, [window], records)
    want_asks, want = _by_client(window, records)
    assert len(asks[0]) == len(want_asks) == requests
    assert got.get(0, []) == want


def test_a_wider_answer_hides_a_slices_repeat_and_slices_add_what_it_left_out(spark):
    # the day 0 comes by both, day 1 by slices alone, day 2 twice in one answer
    records = [_record("A", 0, 4, 4, 0), _record("A", 0, 4, 1000, 1), _record("A", 1, 4, 1000, 2), _record("A", 2, 4, 4, 3), _record("A", 2, 4, 4, 4)]
    window = _window("A", 4)
    _, got = _by_plan(spark, [window], records)
    assert got[0] == _by_client(window, records)[1]
    assert [json.loads(x)["views"] for x in got[0]] == [0, 2, 3, 4]


def test_days_of_a_pad_are_no_answer(spark):
    records = [_record("A", -10, None, None, 0), _record("A", 1, 1, 33, 1)]
    window = _window("A", 4)
    asks, got = _by_plan(spark, [window], records)
    assert [(b - a).days + 1 for a, b in asks[0][:3]] == [4, 19, 34]
    assert [json.loads(x)["views"] for x in got[0]] == [1]


def test_odd_rows(spark):
    """Equal windows are one; without days, or backwards, they ask nothing; null titles meet no record."""
    w = [_window("A", 2), _window("A", 2), ("b", "A", D, D, None, D, 1), ("c", "A", D, D, D + timedelta(days=1), D, 2), ("d", None, D, D, D, D, 3)]
    r = [("A", None, None, None, 0, "x"), (None, D, None, None, 0, "x"), *[_record("A", 0, None, 5, 1)] * 2]
    asks, got = _by_plan(spark, w, r)
    assert {k: len(v) for k, v in asks.items()} == {0: 1, 3: 3}
    assert {k: len(v) for k, v in got.items()} == {0: 2}
    empty_w, empty_r = spark.createDataFrame([], WINDOWS), spark.createDataFrame([], RECORDS)
    assert items.recorded(empty_r)(spark.createDataFrame(w, WINDOWS)).count() == 0
    assert verify.requests(verify.verified(empty_w, empty_r)).count() == 0


def test_the_plan_has_no_python(spark):
    w, r = spark.createDataFrame([_window("A", 30)], WINDOWS), spark.createDataFrame([_record("A", 0, 1, 7, 0)], RECORDS)
    plan = verify.requests(verify.verified(w, r.where(F.col("pos") >= 0)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_run_over_recorded_answers(spark, tmp_path):
    from tidegate.plans.engine import run
    from tidegate.plans.warehouse import Warehouse
    from tidegate.schema import Venue

    days = [date(2026, 2, 20) + timedelta(days=i) for i in range(8)]
    # wide questions see nothing: only slices of up to three days do
    r = spark.createDataFrame([("A", d, 4, 1000, i, _raw("A", d, i)) for i, d in enumerate(days)], RECORDS)
    w = Warehouse(spark, str(tmp_path / "w"))
    s = run(w, [Venue("a", "A", "r", "A")], today=date(2026, 3, 1), backfill_days=10, source=items.recorded(r))
    assert (s.status, s.rows_fetched, s.rows_loaded) == ("ok", 8, 8)
    assert {x.view_date for x in w.read("pageviews").collect()} == set(days)
