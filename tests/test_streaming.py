"""Streams of item files: state across batches, and commits that happen once."""

import json
import os
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators.rules import judge
from tidegate.plans.warehouse import Warehouse
from tidegate.streaming.trigger import item_stream, judge_stream, load_stream

TODAY = date(2026, 3, 1)
FIRST = date(2026, 1, 1)


def row(seq, venue, day, views, article=None, window=FIRST):
    raw = {"article": article or venue, "timestamp": f"{day:%Y%m%d}00" if isinstance(day, date) else day, "views": views}
    span = {"venue_start": f"{window}", "venue_end": f"{window + timedelta(days=29)}", "window_start": f"{window}", "window_end": f"{window + timedelta(days=29)}"}
    return {"venue_id": venue, "article": venue, **span, "seq": seq, "raw": json.dumps(raw)}


def some_items():
    """Days that repeat near and far apart, in one window and in two, clean and not; and views beyond what a double tells."""
    day = lambda i: FIRST + timedelta(days=i)
    out = []
    for i in range(60):
        venue = f"v{i % 3}"
        out.append(row(len(out), venue, day(i % 7), 2**62 + i))
        if i % 10 == 0:
            out.append(row(len(out), venue, day(9), -1))
        if i % 11 == 0:
            out.append(row(len(out), venue, "20260231" + "00", 5))
        if i % 13 == 0:
            out.append(row(len(out), venue, day(i % 7), 7, window=FIRST - timedelta(days=3)))
        if i % 17 == 0:
            out.append(row(len(out), venue, day(i % 7), 7, article="Other"))
    return out


def land(folder, parts):
    """A file for each part, older ones first."""
    folder.mkdir()
    for i, part in enumerate(parts):
        f = folder / f"{i:03}.json"
        f.write_text("\n".join(map(json.dumps, part)))
        os.utime(f, (1_000_000 + i, 1_000_000 + i))
    return str(folder)


def cut(rows, n):
    size = -(-len(rows) // n)
    return [rows[i : i + size] for i in range(0, len(rows), size)]


COLS = ["venue_id", "article", "window_start", "seq", "raw", "view_date", "views", "rule", "detail"]


def test_any_cut_into_batches_gives_the_rows_of_one_batch(spark, tmp_path):
    rows = some_items()
    whole = spark.read.schema(schema.ITEMS).json(land(tmp_path / "whole", [rows]))
    want = Counter(map(tuple, judge(whole, F.lit(TODAY)).select(COLS).collect()))
    assert sum("already seen" in (r[-1] or "") for r in want.elements()) > 20
    for n in (1, 2, 9):
        got, batches = Counter(), []
        path = land(tmp_path / f"in{n}", cut(rows, n))

        def sink(df, k, got=got, batches=batches):
            batches.append(k)
            got.update(map(tuple, df.select(COLS).collect()))

        judge_stream(item_stream(spark, path, maxFilesPerTrigger="1"), str(tmp_path / f"cp{n}"), sink, TODAY).awaitTermination(120)
        assert len(batches) >= n and got == want, n


def test_state_outlives_the_stream(spark, tmp_path):
    """A day that has come is known to the next start from the same checkpoint."""
    got = []
    sink = lambda df, k: got.extend(df.select("rule", "detail").collect())
    path = land(tmp_path / "in", [[row(0, "v", FIRST, 5)]])
    for views in (6, 7):
        judge_stream(item_stream(spark, path), str(tmp_path / "cp"), sink, TODAY).awaitTermination(60)
        (tmp_path / f"in/{views}.json").write_text(json.dumps(row(views, "v", FIRST, views)))
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    judge_stream(item_stream(spark, path), str(tmp_path / "cp"), sink, TODAY).awaitTermination(60)
    assert spark.conf.get(key, None) == before
    assert [tuple(r) for r in got] == [(None, None)] + [("one_row_per_date", f"{FIRST} already seen with 5 views")] * 2


def contents(w):
    drop = {"pageviews": ["loaded_at"], "quarantine": ["seen_at"], "run_log": ["started_at", "finished_at"]}
    return {t: Counter(map(tuple, w.read(t).drop(*c).collect())) for t, c in drop.items()}


def good_items(bad_every=40):
    day = lambda i: FIRST + timedelta(days=i % 30)
    return [row(i, f"v{i // 30}", day(i), -1 if i % bad_every == 0 else i) for i in range(150)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_batch_is_committed_once(spark, tmp_path, monkeypatch, when):
    path, cp = land(tmp_path / "in", cut(good_items(), 3)), str(tmp_path / "cp")
    w = Warehouse(spark, str(tmp_path / "wh"))
    publish, calls = Warehouse._publish, []

    def killed(self, manifest):
        calls.append(1)
        if len(calls) == 2 and when == "before":
            raise RuntimeError("killed")
        publish(self, manifest)
        if len(calls) == 2:
            raise RuntimeError("killed")

    start = lambda: load_stream(item_stream(spark, path, maxFilesPerTrigger="1"), w, cp, TODAY, 0.5).awaitTermination(120)
    monkeypatch.setattr(Warehouse, "_publish", killed)
    with pytest.raises(StreamingQueryException):
        start()
    assert w.read("run_log").count() == (1 if when == "before" else 2)
    monkeypatch.setattr(Warehouse, "_publish", publish)
    start()
    once = contents(w)
    assert len(once["run_log"]) == 3 and sum(r[5] for r in once["run_log"].elements()) == 150 - 4
    assert len(once["pageviews"]) == 150 - 4 and sum(once["quarantine"].values()) == 4
    # the last batch again, as its end was not noted: what stands stays as it is
    version = w.manifest()["version"]
    for name in ("2", ".2.crc"):
        (tmp_path / "cp/commits" / name).unlink(missing_ok=True)
    start()
    assert contents(w) == once and w.manifest()["version"] == version
    assert not (tmp_path / "wh/_staging").exists() or not list((tmp_path / "wh/_staging").iterdir())


def test_gates_of_a_batch(spark, tmp_path):
    """A venue above the ceiling is held; a batch in which most are loads nothing but its rejects, and the stream goes on."""
    day = lambda i: FIRST + timedelta(days=i)
    one = [row(i, f"v{i % 3}", day(i // 3), -1 if i % 3 == 0 else 4) for i in range(30)]
    two = [row(100 + i, f"w{i % 3}", day(i // 3), -1 if i % 3 else 4) for i in range(30)]
    three = [row(200 + i, "w0", day(20 + i), 9) for i in range(5)]
    w = Warehouse(spark, str(tmp_path / "wh"))
    load_stream(item_stream(spark, land(tmp_path / "in", [one, two, three]), maxFilesPerTrigger="1"), w, str(tmp_path / "cp"), TODAY).awaitTermination(120)
    log = w.read("run_log").orderBy("started_at").select("status", "venues", "rows_fetched", "rows_loaded", "rows_quarantined").collect()
    assert [tuple(r) for r in log] == [("ok", 3, 30, 20, 10), ("failed", 3, 30, 0, 20), ("ok", 1, 5, 5, 0)]
    assert Counter(r.venue_id for r in w.read("pageviews").collect()) == {"v1": 10, "v2": 10, "w0": 5}
    assert w.read("quarantine").count() == 30
