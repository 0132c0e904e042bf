"""A run: plan, fetch, judge, gate, commit."""

from __future__ import annotations

import contextlib
import logging
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.operators import frontier, gate, planning, rules
from tidegate.params import Days, Params
from tidegate.plans import reports
from tidegate.plans.cancel import Cancellation
from tidegate.plans.warehouse import Commit, Warehouse, utc_now
from tidegate.schema import ApiError, QualityGateFailed, RunCancelled, RunSummary, SchemaDriftError, Venue
from tidegate.sources.dimension import venues_frame
from tidegate.sources.items import CALL, OnExecutors

log = logging.getLogger(__name__)
_ERROR_LINE = re.compile(r"[A-Za-z_][\w.]*(?:Error|Exception|Interrupt|Exit|Warning)\b")
_KNOWN = {c.__name__: c for c in (ApiError, SchemaDriftError, QualityGateFailed, ValueError, TypeError, RuntimeError, OSError, KeyError)}


def _failure(kind: str, message: str) -> Exception:
    """An error that came back as a row, as the exception that it was."""
    made = _KNOWN.get(kind) or type(kind, (RuntimeError,), {})
    return made(message)


@dataclass
class _Run:
    """What a run has come to so far; a failure's log tells it."""

    summary: RunSummary
    started: datetime
    notes: list[str]
    bad: DataFrame | None = None
    months: list[str] | None = None
    cancellation: Cancellation | None = None

    def check(self) -> None:
        """Between two jobs: was the run told to stop?"""
        if self.cancellation is not None:
            self.cancellation.check()

    def note(self, *more: str) -> str:
        return "; ".join(x for x in (*self.notes, *more) if x)

    def log_row(self) -> tuple:
        s = asdict(self.summary)
        return (s["run_id"], self.started, utc_now(), s["status"], s["venues"], s["requests"], s["rows_fetched"], s["rows_loaded"], s["rows_quarantined"], float(s["reject_rate"]), s["note"])


def run(
    warehouse: Warehouse,
    venues: list[Venue],
    *,
    today: date | None = None,
    chunk_days: int = schema.CHUNK_DAYS,
    backfill_days: int = schema.BACKFILL_DAYS,
    max_reject_rate: float = schema.MAX_REJECT_RATE,
    max_lookback_days: int = schema.MAX_LOOKBACK_DAYS,
    trust_lag_days: int = schema.TRUST_LAG_DAYS,
    source: Callable[[DataFrame], DataFrame] | None = None,
    cancellation: Cancellation | None = None,
) -> RunSummary:
    """One run over ``venues``; source defaults to the HTTP API, one request at a time.

    A refused run leaves its rejects and its log, so that the next one knows
    them; a failed one its log; an interrupted or cancelled one nothing.
    """
    p = Params(chunk_days, backfill_days, max_reject_rate, max_lookback_days, trust_lag_days)
    days = Days.of(today or datetime.now(UTC).date(), p)
    r = _Run(RunSummary(uuid.uuid4().hex[:12], "running", len(venues)), utc_now(), [], cancellation=cancellation)
    with cancellation or contextlib.nullcontext():
        try:
            return _logged(warehouse, venues, p, days, source or OnExecutors(), r)
        finally:
            if cancellation is not None and cancellation.asked:
                cancellation.settle()
            warehouse.unstage(r.summary.run_id)


def _logged(warehouse: Warehouse, venues: list[Venue], p: Params, days: Days, source: Callable[[DataFrame], DataFrame], r: _Run) -> RunSummary:
    try:
        _attempt(warehouse, venues, p, days, source, r)
    except Exception as e:
        if r.cancellation is not None and r.cancellation.asked:
            raise RunCancelled(f"run {r.summary.run_id} was cancelled") from e
        r.summary.status, r.summary.rows_loaded = "failed", 0
        r.summary.note = r.note(_told(e))
        refused = isinstance(e, QualityGateFailed) and r.bad is not None
        try:
            warehouse.commit(Commit(quarantine=_fresh(warehouse, r) if refused else None, run_log=[r.log_row()]))
        except Exception:
            if not refused:
                raise
            # the log matters more than the rejects
            try:
                warehouse.commit(Commit(run_log=[r.log_row()]))
            except Exception:
                log.exception("the run log of %s could not be written either", r.summary.run_id)
            raise
        raise
    return r.summary


def _told(e: BaseException) -> str:
    """An error's own name and text, without what Spark has wrapped it in."""
    name, text = type(e).__name__, str(e)
    if origin := getattr(e, "java_exception", None) or getattr(e, "_origin", None):
        while origin.getCause() is not None:
            origin = origin.getCause()
        name, text = origin.getClass().getSimpleName(), origin.getMessage() or ""
    if name == "PythonException":  # a worker's traceback, whose last line is the error
        errors = [x for x in text.splitlines() if _ERROR_LINE.match(x)]
        return errors[-1] if errors else text
    return f"{name}: {text}"


def _now() -> Column:
    """UTC wall time, whatever the zones of session and driver."""
    return F.lit(utc_now().isoformat(" ")).cast("timestamp_ntz")


def _as_rejects(bad: DataFrame, run_id: str) -> DataFrame:
    return bad.select(F.lit(run_id).alias("run_id"), "venue_id", "article", "view_date", "rule", "detail", "raw", _now().alias("seen_at"))


def _fresh(warehouse: Warehouse, r: _Run) -> DataFrame:
    return _as_rejects(gate.novel_rejects(r.bad, warehouse.read("quarantine", months=r.months)), r.summary.run_id)


def _attempt(warehouse: Warehouse, venues: list[Venue], p: Params, days: Days, source: Callable[[DataFrame], DataFrame], r: _Run) -> None:
    s, spark = r.summary, warehouse.spark
    m = warehouse.manifest()
    end = F.lit(days.end)
    # one row per stored venue: what plans, alerts and the frontier need of the counts, which aren't read
    history, before = warehouse.stage_counted(frontier.stored_history(warehouse.history(m), end), s.run_id, "history", last_due=F.max("last_due"))
    plan = planning.plan_starts(venues_frame(spark, venues), warehouse.read("watermark", m), history, end, F.lit(days.floor), p.backfill_days)
    plan = warehouse.stage(plan.withColumn("end", end), s.run_id, "plan")
    r.notes.append(reports.stalled_note(plan).first().stalled)

    r.check()
    asked = planning.plan_windows(plan, p.chunk_days)
    windows = asked.select("venue_id", F.col("wiki_article").alias("article"), F.col("start").alias("venue_start"), F.col("end").alias("venue_end"), "window_start", "window_end", "ord", "window_no")
    # requests in order, venue by venue; a venue has no more windows than days to look back
    windows = windows.withColumn("call", F.col("ord").cast("long") * p.max_lookback_days + F.col("window_no")).drop("ord", "window_no")
    windows, planned = warehouse.stage_counted(windows, s.run_id, "windows", requests=F.count(F.lit(1)))
    r.check()
    items, fetched = warehouse.stage_counted(source(windows), s.run_id, "items", **reports.fetch_counters())
    s.requests, failed = planned["requests"], fetched["failed"]
    if failed is not None:
        s.requests = windows.where(F.col("call") <= failed.seq // CALL).count()
        s.rows_fetched = items.where(F.col("error_type").isNull() & (F.col("seq") < failed.seq)).count()
        raise _failure(failed.error_type, failed.error)
    r.check()
    judged, got = warehouse.stage_counted(rules.judge(items, F.lit(days.today)), s.run_id, "judged", **reports.judged_counters(end))
    clean, bad = judged.where("rule is null"), judged.where("rule is not null")
    r.bad, r.months = bad, list(got["reject_months"])

    stats = frontier.venue_stats(judged)
    seen = plan.where("start <= end").join(stats, "venue_id", "left").join(history, "venue_id", "left").fillna(0, ["n_clean", "n_bad"]).fillna(False, ["unknown_bad"])
    novel = gate.novel_rejects(bad, warehouse.read("quarantine", m, r.months))
    fresh = gate.held_venues(seen.withColumn("seen", F.col("n_clean") + F.col("n_bad")), novel, p.max_reject_rate)
    evidence = [d for d in (before["last_due"], got["last_clean"]) if d is not None]
    trusted = F.lit(min(days.trust_line, max(evidence)) if evidence else None).cast("date")
    far = frontier.venue_frontier(F.col("start"), end, trusted, F.col("last_clean"), F.col("first_bad"), F.col("unknown_bad"))
    per = fresh.withColumn("new", frontier.advance(far, F.col("current")))
    last = F.greatest("last_stored", "last_clean")
    per = per.withColumn("alert", frontier.alert(F.col("venue_id"), F.col("wiki_article"), F.col("last_stored").isNotNull(), F.col("n_clean"), F.col("n_bad"), last, end, F.coalesce("new", "current"), p.trust_lag_days))
    r.check()
    per = warehouse.stage(per, s.run_id, "venues")
    # one row, however many venues
    v = reports.run_report(per).first()

    r.notes += [v.silent, v.known, v.held_note]
    s.rows_fetched, s.rows_quarantined = got["rows_fetched"], got["rows_quarantined"]
    s.reject_rate = s.rows_quarantined / s.rows_fetched if s.rows_fetched else 0.0
    gate.enforce_majority(v.answering, v.n_held, p.max_reject_rate)
    gate.enforce_gate(v.gate_seen, v.gate_fresh, p.max_reject_rate)

    now = _now()
    rows = gate.drop_held(clean, per).select("venue_id", "article", "view_date", "views", F.lit(s.run_id).alias("run_id"), now.alias("loaded_at"))
    marks = per.where("not held and new is not null").select("venue_id", F.col("new").alias("last_date"), now.alias("updated_at"))
    s.note, s.status, s.rows_loaded = r.note(), "ok", v.rows_loaded
    r.check()
    warehouse.commit(
        Commit(
            pageviews=rows if s.rows_loaded else None,
            quarantine=_as_rejects(bad, s.run_id) if s.rows_quarantined else None,
            watermark=marks if v.marks else None,
            run_log=[r.log_row()],
        ),
        base=m,
    )
