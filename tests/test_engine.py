"""Runs against a warehouse in a temporary folder."""

import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators import frontier
from tidegate.plans import warehouse as wh
from tidegate.plans.engine import run
from tidegate.plans.warehouse import Warehouse
from tidegate.schema import QualityGateFailed, SchemaDriftError, Venue
from tidegate.sources.items import OnDriver, OnExecutors, synthetic

TODAY = date(2026, 3, 1)
TWO = [Venue("sky", "Sky Tower", "Auckland", "Sky_Tower"), Venue("milford", "Milford Sound", "Southland", "Milford_Sound")]
EIGHT = [Venue(f"v{i}", f"V {i}", "r", f"Article_{i}") for i in range(8)]


def item(article, day, views=10, **more):
    return {"project": "en.wikipedia", "article": article, "granularity": "daily", "timestamp": f"{day:%Y%m%d}00", "access": "all-access", "agent": "user", "views": views, **more}


def daily(article, start, end, views=10):
    return [item(article, start + timedelta(days=i), views) for i in range((end - start).days + 1)]


class Asked:
    def __init__(self, answer=daily):
        self.calls, self.answer = [], answer

    def __call__(self, article, start, end):
        self.calls.append((article, start, end))
        return self.answer(article, start, end)


def night(w, venues, answer=daily, today=TODAY, **how):
    return run(w, venues, today=today, source=OnDriver(answer), **how)


def rows(w, table):
    return w.read(table).collect()


@pytest.fixture
def w(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_two_synthetic_runs(spark, w):
    a = run(w, EIGHT, today=TODAY, source=synthetic)
    assert (a.requests, a.rows_fetched, a.rows_loaded, a.rows_quarantined, a.status) == (24, 720, 720, 0, "ok")
    b = run(w, EIGHT, today=date(2026, 3, 4), source=synthetic)
    assert (b.requests, b.rows_fetched, b.rows_loaded, b.rows_quarantined) == (8, 24, 24, 0)
    p = w.read("pageviews")
    assert p.count() == 744 and p.groupBy("venue_id", "view_date").count().where("count > 1").isEmpty()
    assert {r.last_date for r in rows(w, "watermark")} == {date(2026, 3, 2)}
    log = rows(w, "run_log")
    assert sorted(r.rows_loaded for r in log) == [24, 720] and all(r.status == "ok" for r in log)


def test_third_run_of_a_day_asks_for_nothing(spark, w):
    night(w, TWO, backfill_days=10)
    asked = Asked()
    s = night(w, TWO, asked)
    assert (s.requests, asked.calls) == (0, [])


def test_restatement_overwrites(spark, w):
    night(w, TWO[:1], backfill_days=5)
    w.commit(wh.Commit())
    m = w.manifest()
    m["watermark"] = []
    m["version"] += 1
    w._publish(m)
    night(w, TWO[:1], lambda a, s, e: daily(a, s, e, 99), backfill_days=5)
    got = rows(w, "pageviews")
    assert len(got) == 5 and {r["views"] for r in got} == {99} and len({r["run_id"] for r in got}) == 1


def test_executors_fetch_too(spark, w):
    # by value: executors need not import the tests
    def answer(article, start, end):
        from datetime import timedelta

        return [
            {"project": "en.wikipedia", "article": article, "granularity": "daily", "timestamp": (start + timedelta(days=i)).strftime("%Y%m%d00"), "access": "all-access", "agent": "user", "views": i}
            for i in range((end - start).days + 1)
        ]

    s = run(w, TWO, today=TODAY, backfill_days=40, source=OnExecutors(answer, parallelism=2))
    assert (s.requests, s.rows_loaded) == (4, 80)


def test_rejected_day_holds_watermark_and_later_heals(spark, w):
    poison = date(2026, 2, 20)

    def bad(article, start, end):
        return [item(article, d, -4 if article == "Sky_Tower" and d == poison else 10) for d in (start + timedelta(days=i) for i in range((end - start).days + 1))]

    s = night(w, TWO, bad, backfill_days=30, max_reject_rate=0.1)
    assert (s.rows_loaded, s.rows_quarantined) == (59, 1)
    marks = {r.venue_id: r.last_date for r in rows(w, "watermark")}
    assert marks == {"sky": date(2026, 2, 19), "milford": date(2026, 2, 27)}
    q = rows(w, "quarantine")[0]
    assert (q.rule, q.view_date, q.venue_id) == ("views_non_negative", poison, "sky")
    s = night(w, TWO, bad, backfill_days=30)
    assert "1 of 1 rejected rows were already quarantined; gate saw 0" in s.note and s.status == "ok"
    assert len(rows(w, "quarantine")) == 2  # a passing run appends what it rejects, known or not
    night(w, TWO, daily)
    assert {r.last_date for r in rows(w, "watermark")} == {date(2026, 2, 27)}


def test_one_broken_venue_is_held_and_the_rest_load(spark, w):
    def drifted(article, start, end):
        return daily("Elsewhere" if article == "Article_3" else article, start, end)

    s = night(w, EIGHT, drifted, backfill_days=10)
    assert (s.status, s.rows_loaded, s.rows_quarantined) == ("ok", 70, 10)
    assert "v3: 10/10 newly rejected, above the ceiling, held" in s.note
    assert "v3: no rows ever, 10 row(s) rejected, check 'Article_3'" in s.note
    assert "v3" not in {r.venue_id for r in rows(w, "watermark")}
    s = night(w, EIGHT, drifted, backfill_days=10)
    assert "held" not in s.note


def test_held_venues_clean_rows_do_not_load(spark, w):
    night(w, EIGHT, backfill_days=10)

    def bad(article, start, end):
        return [item(article, start + timedelta(days=i), -1 if article == "Article_0" and i < 2 else 77) for i in range((end - start).days + 1)]

    night(w, EIGHT, bad, today=TODAY + timedelta(days=4))
    assert w.read("pageviews").where("venue_id = 'v0' and views = 77").isEmpty()
    assert not w.read("pageviews").where("venue_id = 'v1' and views = 77").isEmpty()


def test_majority_refuses_then_heals(spark, w):
    def broken(article, start, end):
        return daily(article, start, end, -1 if int(article[-1]) < 5 else 10)

    with pytest.raises(QualityGateFailed, match="5 of 8"):
        night(w, EIGHT, broken, backfill_days=10)
    assert rows(w, "pageviews") == [] and rows(w, "watermark") == []
    assert len(rows(w, "quarantine")) == 50
    log = rows(w, "run_log")[0]
    assert (log.status, log.rows_loaded, log.rows_quarantined, log.reject_rate) == ("failed", 0, 50, 50 / 80)
    assert log.note.endswith("Nothing was loaded.") and "QualityGateFailed" in log.note
    s = night(w, EIGHT, broken, backfill_days=10)
    assert s.status == "ok" and s.rows_loaded == 30


def test_refused_again_adds_no_rejects(spark, w):
    n = iter(range(100))

    def broken(article, start, end):
        k = next(n)
        return daily(article, start, end, -1) if k < 8 else [item(article, d["timestamp"] and date(2026, 2, 18), "x") for d in daily(article, start, end)[:1]] + daily(article, start, end, -1)

    for _ in range(2):
        with pytest.raises(QualityGateFailed):
            night(w, EIGHT, broken, backfill_days=10, max_reject_rate=0.0)
    assert len(rows(w, "quarantine")) == 88


def test_failure_is_logged_and_raised_as_it_was(spark, w):
    def fails(article, start, end):
        if article == "Milford_Sound":
            raise SchemaDriftError("no 'items'")
        return daily(article, start, end)

    with pytest.raises(SchemaDriftError):
        night(w, TWO, fails, backfill_days=60)
    log = rows(w, "run_log")[0]
    assert (log.requests, log.rows_fetched, log.rows_loaded, log.rows_quarantined, log.status) == (3, 60, 0, 0, "failed")
    assert log.note == "SchemaDriftError: no 'items'" and rows(w, "pageviews") == []


def test_interrupt_leaves_nothing(spark, w, monkeypatch):
    monkeypatch.setattr(Warehouse, "_publish", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
    before = w.manifest()
    with pytest.raises(KeyboardInterrupt):
        night(w, TWO, backfill_days=5)
    assert w.manifest() == before and rows(w, "run_log") == []


def test_no_evidence_means_hold(spark, w):
    s = night(w, TWO, lambda *_: [], backfill_days=20)
    assert s.status == "ok" and rows(w, "watermark") == []
    assert s.note == "sky: no rows ever, check 'Sky_Tower'; milford: no rows ever, check 'Milford_Sound'"


def test_quiet_venue_follows_the_trust_line_on_others_evidence(spark, w):
    night(w, TWO, lambda a, s, e: daily(a, s, e) if a == "Sky_Tower" else [], backfill_days=20)
    marks = {r.venue_id: r.last_date for r in rows(w, "watermark")}
    assert marks == {"sky": date(2026, 2, 27), "milford": date(2026, 2, 22)}


def test_stalled_publication_holds(spark, w):
    published = date(2026, 2, 10)
    night(w, TWO, lambda a, s, e: daily(a, s, min(e, published)), backfill_days=30)
    assert {r.last_date for r in rows(w, "watermark")} == {published}


def test_gone_dark_is_named(spark, w):
    night(w, TWO, backfill_days=5)
    s = night(w, TWO, lambda *_: [], today=TODAY + timedelta(days=9))
    assert "sky: no rows for 9 days (watermark 2026-02-27), check 'Sky_Tower'" in s.note


def test_lookback_limit(spark, w):
    s = night(w, TWO[:1], backfill_days=40, max_lookback_days=30)
    assert s.note == "sky: gave up on 10 days" and s.rows_loaded == 30


def test_watermark_without_rows_is_not_believed(spark, w):
    m = w.spark.createDataFrame([("sky", date(2026, 2, 25), wh.utc_now())], "venue_id string, last_date date, updated_at timestamp_ntz")
    w.commit(wh.Commit(watermark=m))
    asked = Asked()
    night(w, TWO[:1], asked, backfill_days=10)
    assert asked.calls == [("Sky_Tower", date(2026, 2, 18), date(2026, 2, 27))]


@pytest.mark.parametrize("bad", [{"chunk_days": 0}, {"chunk_days": True}, {"backfill_days": 1.5}, {"max_reject_rate": float("nan")}, {"max_reject_rate": 2}, {"max_reject_rate": True}, {"trust_lag_days": -1}, {"max_lookback_days": "9"}])
def test_bad_parameters_touch_nothing(spark, w, bad):
    with pytest.raises(ValueError):
        night(w, TWO, **bad)
    assert rows(w, "run_log") == []


def test_old_folders_lack_a_column(spark, w):
    p = f"{w.path}/quarantine/old"
    spark.createDataFrame([("r", "sky", "A", "views_non_negative", "got -1", "{}")], "run_id string, venue_id string, article string, rule string, detail string, raw string").write.parquet(p)
    m = w.manifest()
    m["quarantine"].append("quarantine/old")
    m["version"] += 1
    w._publish(m)
    night(w, TWO, lambda a, s, e: [item(a, s, -1)] + daily(a, s + timedelta(days=1), e), backfill_days=30)
    q = w.read("quarantine")
    assert q.count() == 3 and q.where("view_date is null").count() == 1


def test_null_day_is_known_the_second_time(spark, w):
    def odd(article, start, end):
        return [*daily(article, start, end), item(article, start, 5, timestamp="2026-02-01")]

    night(w, TWO, odd, backfill_days=30)
    assert rows(w, "watermark") == []
    s = night(w, TWO, odd, backfill_days=30)
    assert "2 of 2 rejected rows were already quarantined; gate saw 0" in s.note


def test_compact_and_vacuum(spark, w):
    bad = lambda a, s, e: [item(a, s, -1), *daily(a, s + timedelta(days=1), e)]
    for _ in range(2):
        night(w, TWO, bad, backfill_days=30)
    n = w.read("quarantine").count()
    w.compact("quarantine")
    assert len(w.manifest()["quarantine"]) == 1 and w.read("quarantine").count() == n
    assert w.vacuum() > 0 and w.read("quarantine").count() == n


def test_manifest_is_plain_json(w):
    assert json.loads(json.dumps(w.manifest()))["version"] == 0


def test_commit_is_all_or_nothing(spark, w, monkeypatch):
    night(w, TWO, backfill_days=5)
    before = {t: sorted(map(str, rows(w, t))) for t in ("pageviews", "quarantine", "watermark", "run_log")}
    real = Warehouse._write

    def write(self, df, table):
        if table == "watermark":
            raise OSError("disk full")
        return real(self, df, table)

    monkeypatch.setattr(Warehouse, "_write", write)
    with pytest.raises(OSError, match="disk full"):
        night(w, TWO, today=TODAY + timedelta(days=3))
    monkeypatch.undo()
    assert {t: sorted(map(str, rows(w, t))) for t in ("pageviews", "quarantine", "watermark")} == {t: before[t] for t in ("pageviews", "quarantine", "watermark")}
    log = {r.status: r for r in rows(w, "run_log")}
    assert log["failed"].note == "OSError: disk full" and log["failed"].rows_loaded == 0 and log["ok"].rows_loaded == 10


def test_log_of_a_refused_run_survives_a_failing_reject_table(spark, w, monkeypatch):
    real = Warehouse._write

    def write(self, df, table):
        if table == "quarantine":
            raise OSError("disk full")
        return real(self, df, table)

    monkeypatch.setattr(Warehouse, "_write", write)
    with pytest.raises(OSError):
        night(w, TWO, lambda a, s, e: daily(a, s, e, -1), backfill_days=5)
    log = rows(w, "run_log")
    assert len(log) == 1 and "QualityGateFailed" in log[0].note and rows(w, "quarantine") == []


def test_upsert_rewrites_only_touched_months(spark, w):
    night(w, TWO[:1], backfill_days=60)
    old = w.manifest()["pageviews"]
    night(w, TWO[:1], today=TODAY + timedelta(days=4))
    new = w.manifest()["pageviews"]
    assert sorted(old) == ["2025-12", "2026-01", "2026-02"] and new["2025-12"] == old["2025-12"] and new["2026-01"] == old["2026-01"]
    assert new["2026-02"] != old["2026-02"] and w.read("pageviews").count() == 64


def test_neighbouring_window_day_is_rejected_and_holds(spark, w):
    # a row of the second window's days in the first window's answer
    def stray(article, start, end):
        more = [item(article, end + timedelta(days=1))] if end < date(2026, 2, 1) else []
        return daily(article, start, end) + more

    s = night(w, TWO[:1], stray, backfill_days=60, max_reject_rate=0.5)
    q = rows(w, "quarantine")
    assert s.rows_quarantined == 1 and q[0].rule == "date_in_requested_window"
    assert rows(w, "watermark")[0].last_date == q[0].view_date - timedelta(days=1)


def test_strays_outside_the_range_do_not_hold(spark, w):
    night(w, TWO[:1], lambda a, s, e: [item(a, s - timedelta(days=365)), *daily(a, s, e)], backfill_days=30, max_reject_rate=0.5)
    assert rows(w, "watermark")[0].last_date == date(2026, 2, 27)


def test_absent_days_are_asked_for_until_settled(spark, w):
    hole = {date(2026, 2, 24), date(2026, 2, 25), date(2026, 2, 26), date(2026, 2, 27)}
    night(w, TWO[:1], lambda a, s, e: [x for x in daily(a, s, e) if date(int(x["timestamp"][:4]), int(x["timestamp"][4:6]), int(x["timestamp"][6:8])) not in hole], backfill_days=10)
    assert rows(w, "watermark")[0].last_date == date(2026, 2, 23)
    asked = Asked()
    night(w, TWO[:1], asked, today=TODAY + timedelta(days=1))
    assert asked.calls == [("Sky_Tower", date(2026, 2, 24), date(2026, 2, 28))] and w.read("pageviews").count() == 11


def test_a_second_writer_is_refused(spark, w):
    """Of two runs from one snapshot the first holds; the other fails, and its log tells."""
    base = w.manifest()
    night(w, TWO[:1], backfill_days=5)
    with pytest.raises(wh.ConcurrentCommit):
        w.commit(wh.Commit(), base=base)

    def meanwhile(a, s, e):
        if not seen:
            seen.append(night(w, TWO[1:], backfill_days=5))
        return daily(a, s, e)

    seen = []
    before = len(rows(w, "pageviews"))
    with pytest.raises(wh.ConcurrentCommit):
        night(w, TWO[:1], meanwhile, today=TODAY + timedelta(days=3))
    assert len(rows(w, "pageviews")) == before + 5
    assert sorted(r["status"] for r in rows(w, "run_log")) == ["failed", "ok", "ok"]
    # changes that build on no snapshot both hold
    two = [wh.Warehouse(spark, w.path) for _ in range(2)]
    for i, x in enumerate(two):
        x.commit(wh.Commit(run_log=[(f"r{i}", wh.utc_now(), None, "ok", 0, 0, 0, 0, 0, 0.0, None)]))
    assert {"r0", "r1"} <= {r["run_id"] for r in rows(w, "run_log")}


def test_stamps_are_utc_in_any_zone(spark, w):
    from datetime import datetime, timezone

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        night(w, TWO, lambda a, s, e: [item(a, s, -1), *daily(a, s + timedelta(days=1), e)], backfill_days=30)
        stamps = [r["loaded_at"] for r in rows(w, "pageviews")] + [r["seen_at"] for r in rows(w, "quarantine")] + [r["updated_at"] for r in rows(w, "watermark")] + [r["started_at"] for r in rows(w, "run_log")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    assert len(stamps) > 30 and all(timedelta(0) <= now - s < timedelta(minutes=30) for s in stamps)


def test_errors_are_logged_by_their_own_name(spark, w):
    def broken(windows):
        return windows.selectExpr("*", "call as seq", "raise_error('no such luck') as raw", "cast(null as string) error_type", "cast(null as string) error")

    def crashes(batches):
        for _ in batches:
            raise ZeroDivisionError("by hand")
        yield from ()

    with pytest.raises(Exception):
        run(w, TWO, today=TODAY, source=broken)
    with pytest.raises(Exception):
        run(w, TWO, today=TODAY, source=lambda x: x.mapInPandas(crashes, schema.ITEMS))
    notes = [r["note"] for r in sorted(rows(w, "run_log"), key=lambda r: r["started_at"])]
    assert "no such luck" in notes[0] and not notes[0].startswith(("Py4JJavaError", "SparkException:"))
    assert notes[1].endswith("ZeroDivisionError: by hand")


def test_runs_leave_no_staging(spark, w):
    import os

    night(w, TWO, backfill_days=40)
    with pytest.raises(OSError):
        night(w, TWO, lambda a, s, e: (_ for _ in ()).throw(OSError("down")), backfill_days=40, today=TODAY + timedelta(days=3))
    assert not os.listdir(f"{w.path}/_staging")
    # a job of many months writes one folder
    assert len({n.rsplit("/", 1)[0] for n in w.manifest()["pageviews"].values()}) == 1 and len(w.manifest()["pageviews"]) > 1
    night(w, TWO, backfill_days=40, today=TODAY + timedelta(days=3))
    kept = rows(w, "pageviews")
    assert w.vacuum() >= 0 and rows(w, "pageviews") == kept and len(os.listdir(f"{w.path}/_manifests")) <= 2


def test_counters_and_notes_cost_no_jobs_of_their_own(spark, w):
    """A run's jobs don't grow with venues or windows; counting in jobs of their own and collecting venues took 38."""
    sc = spark.sparkContext
    for n, venues in enumerate((TWO, EIGHT)):
        sc.setJobGroup(f"run-{n}", "")
        try:
            s = run(w, venues, today=TODAY + timedelta(days=n), source=synthetic)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert s.rows_fetched == s.rows_loaded > 0
        assert len(sc.statusTracker().getJobIdsForGroup(f"run-{n}")) <= 33


def test_summary_of_months_equals_a_full_scan(spark, w, monkeypatch):
    """Kept up through restatements, for any end; an older warehouse's months are summed up from their counts."""

    def same(end):
        scan = w.read("pageviews").groupBy("venue_id").agg(F.max("view_date").alias("last"), F.max(F.when(F.col("view_date") <= F.lit(end), F.col("view_date"))).alias("due"))
        want = {tuple(r) for r in scan.collect()}
        return {tuple(r) for r in frontier.stored_history(w.history(), F.lit(end)).select("venue_id", "last_stored", "last_due").collect()} == want != set()

    night(w, TWO, backfill_days=70)
    night(w, TWO[:1], today=TODAY + timedelta(days=5))
    w.commit(wh.Commit(pageviews=w.read("pageviews").where("view_date between '2026-01-10' and '2026-01-20'").withColumn("views", F.lit(7).cast("long"))))
    ends = [date(2026, 1, 31), date(2026, 2, 1), date(2026, 2, 14), date(2025, 12, 1), date(2026, 12, 31)]
    assert all(map(same, ends))
    old = w.manifest()
    old["history"].pop("2026-01")  # as an older writer leaves it: nothing, or what is no longer so
    old["history"]["2026-02"][0] = "pageviews/other"
    old["version"] += 1
    w._publish(old)
    assert all(map(same, ends))
    assert w.vacuum() > 0 and all(map(same, ends))


def test_a_run_reads_no_untouched_month(spark, w, monkeypatch):
    """Its plans scan the counts of no month but those that it writes, and rejects of no other months."""
    one_bad = lambda a, s, e: [item(a, s, -1), *daily(a, s + timedelta(days=1), e)]
    night(w, TWO, one_bad, backfill_days=80, max_reject_rate=0.5)
    scanned = []
    real = Warehouse._folders
    monkeypatch.setattr(Warehouse, "_folders", lambda self, names, kind: scanned.extend(names) or real(self, names, kind))
    night(w, TWO, one_bad, today=TODAY + timedelta(days=45), backfill_days=10, max_reject_rate=0.5)
    counts = {n.rsplit("month=", 1)[1] for n in scanned if n.startswith("pageviews/")}
    assert counts == {"2026-04"} and len(w.manifest()["pageviews"]) > 3
    before = len(w.read("quarantine", months=["2026-01"]).inputFiles())
    rejects = w.read("quarantine").limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(90)))).withColumn("view_date", F.add_months(F.lit(date(2024, 6, 5)), -F.col("n"))).drop("n")
    w.commit(wh.Commit(quarantine=rejects))
    assert w.read("quarantine").count() > 90 and len(w.read("quarantine", months=["2026-01"]).inputFiles()) == before


def test_rejects_of_any_day_have_a_month(spark, w):
    """Far-off and absent days are kept together, and known the second time."""
    def odd(article, start, end):
        return [*daily(article, start, end), item(article, start, 5, timestamp="1850010100"), item(article, start, 5, timestamp="2950010100"), item(article, start, 5, timestamp="x"), item(article, start, 5, timestamp="2031050100")]

    for known in (0, 8):
        s = night(w, TWO, odd, backfill_days=30, max_reject_rate=0.9)
        assert s.rows_quarantined == 8 and ("8 of 8 rejected rows were already" in s.note) == bool(known)
    assert {n.rsplit("month=", 1)[1] for n in w.manifest()["quarantine"]} == {"none", "2031-05"}
