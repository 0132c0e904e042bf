"""The engine's operators bound to the driver's tables, each with its SQL.

events stand for staged items: a user is a venue, a day of events a day of
counts, ``k`` of props the count. Defects are dealt by event_id, so that every
rule fires. customer is the venue list, most of whose venues have no rows.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import json
import shutil
import tempfile
import uuid
import zlib
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.functions import scalars
from tidegate.operators import frontier, gate, merge, planning, rules, verify
from tidegate.plans import engine, reports
from tidegate.plans.warehouse import Commit, Warehouse
from tidegate.schema import Venue
from tidegate.session import bound_batches
from tidegate.sources import contract, items
from tidegate.sources.http import day_text, fetch_window

FIRST = date(2024, 1, 1)
_T, _E, _TRUST = date(2024, 1, 28), date(2024, 1, 26), date(2024, 1, 21)
CEILING = 0.2


def _read(spark: SparkSession, d: str, t: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{t}.parquet")


def shaped(spark: SparkSession, d: str) -> DataFrame:
    e = _read(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    e = e.select(F.col("event_id").alias("seq"), F.col("user_id").cast("string").alias("venue_id"), F.concat(F.lit("A"), "user_id").alias("article"), k.alias("k"), "event_type", F.to_date("ts").alias("d"))
    day = F.date_format("d", "yyyyMMdd")
    tens = F.floor(F.datediff("d", F.lit(FIRST)) / 10).cast("int") + F.when(F.expr("seq % 61 = 0"), 1).otherwise(0)
    return e.select(
        "seq", "venue_id", "article", "k", "d",
        F.when(F.expr("seq % 37 = 0"), F.concat(day, F.lit("12"))).when(F.expr("seq % 41 = 0"), "2024023000").otherwise(F.concat(day, F.lit("00"))).alias("stamp"),
        F.when(F.expr("seq % 43 = 0"), "str").when(F.expr("seq % 47 = 0"), "float").otherwise("int").alias("kind"),
        F.when(F.expr("seq % 47 = 0"), F.concat(F.col("k"), F.lit(".0"))).when(F.expr("seq % 53 = 0"), "9223372036854775808").when(F.expr("seq % 59 = 0"), F.concat(F.lit("-"), F.col("k") + 1)).otherwise(F.col("k").cast("string")).alias("cnt"),
        (~((F.col("event_type") == "error") & F.expr("seq % 20 = 0"))).alias("same"),
        F.date_add(F.lit(FIRST), tens * 10).alias("window_start"),
        F.date_add(F.lit(FIRST), tens * 10 + 9).alias("window_end"),
        F.lit(FIRST).alias("venue_start"), F.lit(_E).alias("venue_end"),
    )


def judged(spark: SparkSession, d: str) -> DataFrame:
    s = shaped(spark, d).withColumn("view_date", scalars.parse_stamp(F.col("stamp")))
    return rules.first_broken_rule(s, F.col("same"), F.col("stamp"), F.col("kind"), F.col("cnt"), F.lit(_T))


_SHAPED = """
base AS (SELECT event_id AS seq, user_id::VARCHAR AS venue_id, 'A' || user_id AS article, (props->>'$.k')::BIGINT AS k, event_type, CAST(ts AS DATE) AS d FROM events),
shaped AS (
  SELECT seq, venue_id, article, k, d,
    CASE WHEN seq % 37 = 0 THEN strftime(d, '%Y%m%d') || '12' WHEN seq % 41 = 0 THEN '2024023000' ELSE strftime(d, '%Y%m%d') || '00' END AS stamp,
    CASE WHEN seq % 43 = 0 THEN 'str' WHEN seq % 47 = 0 THEN 'float' ELSE 'int' END AS kind,
    CASE WHEN seq % 47 = 0 THEN k || '.0' WHEN seq % 53 = 0 THEN '9223372036854775808' WHEN seq % 59 = 0 THEN '-' || (k + 1) ELSE k::VARCHAR END AS cnt,
    NOT (event_type = 'error' AND seq % 20 = 0) AS same,
    (DATE '2024-01-01' + (((d - DATE '2024-01-01') // 10 + CASE WHEN seq % 61 = 0 THEN 1 ELSE 0 END) * 10)::INT) AS window_start
  FROM base
),
dated AS (
  SELECT *, (window_start + 9) AS window_end,
    CASE WHEN regexp_full_match(stamp, '[0-9]{8}00') THEN CAST(try_strptime(stamp[1:8], '%Y%m%d') AS DATE) END AS view_date
  FROM shaped
)"""
_JUDGED = f"""{_SHAPED},
r1 AS (
  SELECT *, CASE
    WHEN NOT same THEN 'article_matches_request' WHEN view_date IS NULL THEN 'timestamp_parses'
    WHEN NOT view_date BETWEEN window_start AND window_end THEN 'date_in_requested_window' WHEN view_date > DATE '2024-01-28' THEN 'date_not_in_future'
    WHEN kind <> 'int' THEN 'views_is_integer' WHEN cnt LIKE '-%' THEN 'views_non_negative' WHEN TRY_CAST(cnt AS BIGINT) IS NULL THEN 'views_within_bigint' END AS r
  FROM dated
),
r2 AS (
  SELECT *, row_number() OVER (PARTITION BY venue_id, window_start, view_date, r IS NULL ORDER BY seq) AS rn,
    first_value(TRY_CAST(cnt AS BIGINT)) OVER (PARTITION BY venue_id, window_start, view_date, r IS NULL ORDER BY seq) AS fv
  FROM r1
),
judged AS (
  SELECT seq, venue_id, article, view_date, window_start, window_end,
    CASE WHEN r IS NULL AND rn > 1 THEN 'one_row_per_date' ELSE r END AS rule,
    CASE WHEN r IS NULL AND rn = 1 THEN cnt::BIGINT END AS views,
    CASE WHEN r IS NULL AND rn > 1 THEN view_date || ' already seen with ' || fv || ' views'
      WHEN r = 'article_matches_request' THEN 'got None, asked for ''' || article || ''''
      WHEN r = 'timestamp_parses' THEN 'expected a daily stamp YYYYMMDD00, got ''' || stamp || ''''
      WHEN r = 'date_in_requested_window' THEN view_date || ' outside ' || window_start || '..' || window_end
      WHEN r = 'date_not_in_future' THEN view_date || ' is after 2024-01-28'
      WHEN r = 'views_is_integer' THEN 'got ' || kind || ' ' || CASE WHEN kind = 'str' THEN '''' || cnt || '''' ELSE cnt END
      WHEN r = 'views_non_negative' THEN 'got ' || cnt
      WHEN r = 'views_within_bigint' THEN 'got ' || cnt || ', above the 9223372036854775807 that the column holds' END AS detail
  FROM r2
),
clean AS (SELECT * FROM judged WHERE rule IS NULL),
bad AS (SELECT * FROM judged WHERE rule IS NOT NULL)"""
_KNOWN = "known AS (SELECT DISTINCT venue_id, view_date, rule FROM bad WHERE seq % 3 = 0)"
_NOVEL = f"{_KNOWN}, novel AS (SELECT bad.* FROM bad WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.venue_id = bad.venue_id AND k.view_date IS NOT DISTINCT FROM bad.view_date AND k.rule = bad.rule))"
_HELD = f"""{_NOVEL},
seen AS (SELECT venue_id, count(*) AS seen FROM judged GROUP BY venue_id),
fresh AS (SELECT venue_id, count(*) AS n FROM novel GROUP BY venue_id),
held AS (SELECT venue_id, seen, coalesce(n, 0) AS fresh, coalesce(n, 0)::DOUBLE / seen::DOUBLE AS rate, coalesce(n, 0)::DOUBLE / seen::DOUBLE > 0.2::DOUBLE AS held FROM seen LEFT JOIN fresh USING (venue_id))"""
_MARKS = "marks AS (SELECT c_custkey::VARCHAR AS venue_id, CASE c_custkey % 3 WHEN 1 THEN DATE '2024-01-10' ELSE DATE '2024-01-25' END AS last_date FROM customer WHERE c_custkey % 3 <> 0)"


def _bad(j: DataFrame) -> DataFrame:
    return j.where("rule is not null")


def _known(j: DataFrame) -> DataFrame:
    return _bad(j).where("seq % 3 = 0")


def _held(j: DataFrame) -> DataFrame:
    seen = j.groupBy("venue_id").agg(F.count(F.lit(1)).alias("seen"))
    return gate.held_venues(seen, gate.novel_rejects(_bad(j), _known(j)), CEILING)


def _venues(spark: SparkSession, d: str) -> DataFrame:
    return _read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("venue_id"), F.col("c_name").alias("wiki_article"), "c_custkey")


def _marks(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("c_custkey") % 3
    return _venues(spark, d).where(key != 0).select("venue_id", F.when(key == 1, F.lit(date(2024, 1, 10))).otherwise(F.lit(date(2024, 1, 25))).alias("last_date"))


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """What is stored before the run: the even events to 12 January."""
    return shaped(spark, d).where("seq % 2 = 0 and d <= date'2024-01-12'").select("venue_id", F.col("d").alias("view_date"))


_STORED = "stored AS (SELECT venue_id, d AS view_date FROM base WHERE seq % 2 = 0 AND d <= DATE '2024-01-12')"


def q_plan_windows(spark, d):
    r = shaped(spark, d).groupBy("venue_id").agg(F.min("d").alias("start"), F.max("d").alias("end"))
    return planning.plan_windows(r, 7).select("venue_id", "window_no", "window_start", "window_end")


def q_start_date_for(spark, d):
    p = planning.plan_starts(_venues(spark, d), _marks(spark, d), _stored(spark, d), F.lit(_E), F.lit(date(2000, 1, 1)), 30)
    return p.select("venue_id", "current", "has_rows", "start")


def q_lookback_floor(spark, d):
    p = planning.plan_starts(_venues(spark, d), _marks(spark, d), _stored(spark, d), F.lit(_E), F.lit(date(2024, 1, 5)), 30)
    return p.where("start <= date'2024-01-25'").select("venue_id", "start", "gave_up")


_STARTS = f"""have AS (SELECT DISTINCT venue_id FROM stored),
starts AS (
  SELECT c_custkey::VARCHAR AS venue_id, last_date AS current, have.venue_id IS NOT NULL AS has_rows,
    CASE WHEN last_date IS NULL THEN DATE '2023-12-28' WHEN have.venue_id IS NULL THEN least(last_date + 1, DATE '2023-12-28') ELSE last_date + 1 END AS start
  FROM customer LEFT JOIN marks ON marks.venue_id = c_custkey::VARCHAR LEFT JOIN have ON have.venue_id = c_custkey::VARCHAR
)"""


def q_parse_daily_stamp(spark, d):
    return shaped(spark, d).select("seq", "stamp", scalars.parse_stamp(F.col("stamp")).alias("view_date"))


def q_first_broken_rule(spark, d):
    return judged(spark, d).select("seq", "view_date", "views", "rule", "detail")


def q_one_row_per_date(spark, d):
    return judged(spark, d).where("rule = 'one_row_per_date'").select("seq", "venue_id", "view_date", "detail")


def q_quarantine_report(spark, d):
    return reports.quarantine_report(_bad(judged(spark, d)))


def q_novel_rejects(spark, d):
    j = judged(spark, d)
    return gate.novel_rejects(_bad(j), _known(j)).select("seq", "venue_id", "view_date", "rule")


def q_novel_by_month(spark, d):
    """New rejects against a quarantine by month, most of it of other years: its other months aren't read."""
    w, j = _warehouse(spark, "months"), judged(spark, d)
    known = _known(j).select(F.lit("r").alias("run_id"), "venue_id", "article", "view_date", "rule", "detail", F.lit(None).cast("string").alias("raw"), F.lit(None).cast("timestamp_ntz").alias("seen_at"))
    older = known.where("view_date is not null").withColumn("years", F.explode(F.sequence(F.lit(1), F.lit(4))))
    w.commit(Commit(quarantine=known))
    w.commit(Commit(quarantine=older.withColumn("view_date", F.add_months("view_date", -12 * F.col("years")))))
    months = [r[0] for r in _bad(j).select(gate.reject_month(F.col("view_date"))).distinct().collect()]
    return gate.novel_rejects(_bad(j), w.read("quarantine", months=months)).select("seq", "venue_id", "view_date", "rule")


def q_stored_history(spark, d):
    """What a run needs of its stored counts, from the summary that commits keep up: orders by customer and day, the last year restated."""
    w = _warehouse(spark, "history")
    o = _read(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("venue_id"), F.lit("orders").alias("article"), F.to_date("o_orderdate").alias("view_date"), "o_orderkey")
    for some, run in (("o_orderkey % 3 <> 0", "first"), ("view_date >= date'1997-08-01'", "again")):
        counts = o.where(some).groupBy("venue_id", "article", "view_date").agg(F.count(F.lit(1)).alias("views"))
        w.commit(Commit(pageviews=counts.select("*", F.lit(run).alias("run_id"), F.lit(None).cast("timestamp_ntz").alias("loaded_at"))))
    return frontier.stored_history(w.history(), F.lit(date(1995, 6, 17)))


def q_held_venues(spark, d):
    return _held(judged(spark, d)).select("venue_id", "seen", "fresh", "rate", "held")


def q_majority_gate(spark, d):
    return gate.verdict(_held(judged(spark, d))).select("answering", "n_held", "majority")


def q_gate_residual(spark, d):
    return gate.verdict(_held(judged(spark, d))).select("gate_seen", "gate_fresh", "gate_rate")


def q_publication_frontier(spark, d):
    o = frontier.publication_frontier(_stored(spark, d), judged(spark, d).where("rule is null"), F.lit(_E))
    return o.select("observed", frontier.trusted_end(F.col("observed"), F.lit(_TRUST)).alias("trusted"))


def _watermarks(spark, d):
    j = judged(spark, d)
    s = frontier.venue_stats(j).join(_marks(spark, d), "venue_id", "left")
    # nothing is trusted for venues that end in 7, as if no evidence were there
    trusted = F.when(~F.col("venue_id").endswith("7"), F.lit(_TRUST))
    far = frontier.venue_frontier(F.lit(FIRST), F.lit(_E), trusted, F.col("last_clean"), F.col("first_bad"), F.col("unknown_bad"))
    return s.withColumn("frontier", far).withColumn("new", frontier.advance(F.col("frontier"), F.col("last_date")))


_STATS = """stats AS (
  SELECT venue_id, count(*) FILTER (rule IS NULL) AS n_clean, count(*) FILTER (rule IS NOT NULL) AS n_bad, max(view_date) FILTER (rule IS NULL) AS last_clean,
    min(view_date) FILTER (rule IS NOT NULL AND view_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-26') AS first_bad,
    coalesce(bool_or(rule IS NOT NULL AND view_date IS NULL), false) AS unknown_bad
  FROM judged GROUP BY venue_id
)"""


def q_venue_stats(spark, d):
    return frontier.venue_stats(judged(spark, d))


def q_venue_watermark(spark, d):
    return _watermarks(spark, d).select("venue_id", "frontier", "new")


def q_venue_alerts(spark, d):
    w = _venues(spark, d).join(_watermarks(spark, d).drop("last_date"), "venue_id", "left").fillna(0, ["n_clean", "n_bad"])
    last = _stored(spark, d).groupBy("venue_id").agg(F.max("view_date").alias("last_stored"))
    w = w.join(last, "venue_id", "left").join(_marks(spark, d), "venue_id", "left")
    a = frontier.alert(F.col("venue_id"), F.col("wiki_article"), F.col("last_stored").isNotNull(), F.col("n_clean"), F.col("n_bad"), F.greatest("last_stored", "last_clean"), F.lit(_E), F.coalesce("new", "last_date"), 7)
    return w.select("venue_id", a.alias("note")).where("note is not null")


def _days(j: DataFrame, odd: int) -> DataFrame:
    """A row for each venue and day of the even or odd events."""
    return j.where(f"seq % 2 = {odd} and rule is null").groupBy("venue_id", "view_date").agg(F.max("views").alias("views"), F.lit(odd).alias("run"))


def q_upsert_pageviews(spark, d):
    j = judged(spark, d)
    return merge.upsert(_days(j, 0), _days(j, 1), ["venue_id", "view_date"])


def q_append_new_rejects(spark, d):
    j = judged(spark, d)
    old = _known(j).select("venue_id", "view_date", "rule", F.lit("old").alias("written"))
    return old.unionByName(gate.novel_rejects(_bad(j), _known(j)).select("venue_id", "view_date", "rule", F.lit("new").alias("written")))


def q_drop_held(spark, d):
    j = judged(spark, d)
    return gate.drop_held(j.where("rule is null"), _held(j)).select("seq", "venue_id", "view_date", "views")


def q_merge_sources(spark, d):
    s = shaped(spark, d).select("venue_id", "stamp", F.col("seq").alias("pos"))
    return merge.merge_sources(s.where("pos % 3 = 0"), s.where("pos % 3 <> 0"), F.lit(date(2024, 1, 5)), F.lit(date(2024, 1, 20)), ["venue_id"]).drop("venue_id")


def _raw(spark, d):
    """Items as JSON text, with counts of every kind."""
    s = shaped(spark, d)
    count = F.when(F.expr("seq % 8 = 0"), F.lit("null")).when(F.expr("seq % 8 = 1"), "true").when(F.expr("seq % 8 = 2"), F.concat(F.lit('"'), F.col("k"), F.lit('"'))).when(F.expr("seq % 8 = 3"), F.concat(F.col("k"), F.lit(".5"))).when(F.expr("seq % 8 = 4"), "[1]").when(F.expr("seq % 8 = 5"), '{"a":1}').otherwise(F.col("k").cast("string"))
    name = F.when(F.expr("seq % 9 = 0"), "agents").otherwise("agent")
    project = F.when(F.expr("seq % 11 = 0"), "de.wikipedia").otherwise("en.wikipedia")
    raw = F.concat(F.lit('{"project":"'), project, F.lit('","article":"'), F.col("article"), F.lit('","granularity":"daily","timestamp":"'), F.col("stamp"), F.lit('","access":"all-access","'), name, F.lit('":"user","views":'), count, F.lit("}"))
    return s.select("seq", raw.alias("raw"))


_RAW = """raws AS (SELECT seq, '{"project":"' || CASE WHEN seq % 11 = 0 THEN 'de.wikipedia' ELSE 'en.wikipedia' END || '","article":"' || article || '","granularity":"daily","timestamp":"' || stamp || '","access":"all-access","'
  || CASE WHEN seq % 9 = 0 THEN 'agents' ELSE 'agent' END || '":"user","views":' || CASE seq % 8 WHEN 0 THEN 'null' WHEN 1 THEN 'true' WHEN 2 THEN '"' || k || '"' WHEN 3 THEN k || '.5' WHEN 4 THEN '[1]' WHEN 5 THEN '{"a":1}' ELSE k::VARCHAR END || '}' AS raw FROM shaped)"""


def q_json_type_check(spark, d):
    return _raw(spark, d).select("seq", scalars.json_kind(F.col("raw"), "views").alias("kind"))


def q_contract_missing_fields(spark, d):
    return _raw(spark, d).select("seq", contract.item_drift(F.col("raw")).alias("drift")).where("drift is not null")


def q_url_build(spark, d):
    p = _read(spark, d, "part")
    name = F.concat("p_name", F.lit(" (é)*~/"), F.col("p_partkey").cast("string"))
    return p.select("p_partkey", scalars.build_url(name, F.lit(FIRST), F.lit(_E)).alias("url"))


def q_venue_profile(spark, d):
    return reports.venue_profile(judged(spark, d).where("rule is null"))


def q_duplicate_pairs(spark, d):
    return reports.duplicate_pairs(shaped(spark, d), "venue_id", "d")


def q_totals_scalar(spark, d):
    return reports.totals(_read(spark, d, "events").select("user_id", F.to_date("ts").alias("d")), "user_id", "d")


def q_recent_runs_topk(spark, d):
    runs = _read(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("started_at"))
    return reports.recent_runs(runs, 10).select("run_id", F.to_date("started_at").alias("day"))


def q_stuck_venues(spark, d):
    return reports.stuck_venues(_watermarks(spark, d).where("new is not null").select("venue_id", F.col("new").alias("last_date")))


def q_synthetic_weekend(spark, d):
    """The synthetic source's items, day by day."""
    n = _read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("venue_id"), F.col("n_name").alias("article"), F.col("n_nationkey").cast("long").alias("call"))
    span = [F.lit(x).alias(c) for c, x in (("venue_start", FIRST), ("venue_end", date(2024, 1, 14)), ("window_start", FIRST), ("window_end", date(2024, 1, 14)))]
    got = items.synthetic(n.select("venue_id", "article", *span, "call"), noise=False)
    return got.select("article", F.get_json_object("raw", "$.timestamp").alias("stamp"), F.get_json_object("raw", "$.views").cast("long").alias("views"))


def q_backoff_clamp(spark, d):
    e = _read(spark, d, "events")
    wish = F.when(F.expr("event_id % 5 = 0"), F.lit(None)).when(F.expr("event_id % 5 = 1"), "soon").when(F.expr("event_id % 5 = 2"), "nan").otherwise((F.col("event_id") - 500).cast("string"))
    return e.select("event_id", scalars.backoff((F.col("event_id") % 9).cast("int"), wish).alias("seconds"))


def q_run_summary(spark, d):
    j = judged(spark, d)
    requests = q_plan_windows(spark, d).agg(F.count(F.lit(1)).alias("requests"))
    t = j.agg(F.count(F.lit(1)).alias("rows_fetched"), F.count_if(F.col("rule").isNotNull()).alias("rows_quarantined"))
    loaded = gate.drop_held(j.where("rule is null"), _held(j)).agg(F.count(F.lit(1)).alias("rows_loaded"))
    return requests.crossJoin(t).crossJoin(loaded).withColumn("reject_rate", scalars.reject_rate(F.col("rows_quarantined"), F.col("rows_fetched")))


def _per_venue(spark, d):
    """What a run's venues come to, the customers being the list: counts, hold, new mark and alert."""
    j = judged(spark, d)
    held = _held(j).select("venue_id", "seen", "fresh", "held")
    marks = _watermarks(spark, d).select("venue_id", "n_clean", "n_bad", "new")
    v = _venues(spark, d).select("venue_id", F.col("venue_id").cast("int").alias("ord")).join(held, "venue_id", "left").join(marks, "venue_id", "left").join(q_venue_alerts(spark, d), "venue_id", "left")
    return v.withColumnRenamed("note", "alert").fillna(0, ["seen", "fresh", "n_clean", "n_bad"]).fillna(False, ["held"])


def q_run_note(spark, d):
    """All notes of a run: venues that gave up days, alerts, known rejects, held venues."""
    plan = planning.plan_starts(_venues(spark, d), _marks(spark, d), _stored(spark, d), F.lit(_E), F.lit(date(2024, 1, 5)), 30).withColumn("ord", F.col("venue_id").cast("int"))
    return reports.run_note(reports.stalled_note(plan), reports.run_report(_per_venue(spark, d)))


def q_run_counters(spark, d):
    """A run's counters, as observed by the tasks that write its judged rows."""
    w = _warehouse(spark, "counters")
    _, got = w.stage_counted(judged(spark, d), "run", "judged", **reports.judged_counters(F.lit(_E)))
    w.unstage("run")
    return spark.createDataFrame([(got["rows_fetched"], got["rows_quarantined"], got["last_clean"])], "rows_fetched long, rows_quarantined long, last_clean date")


def q_title_nfc_match(spark, d):
    bound_batches(spark)
    docs = _read(spark, d, "documents").select("doc_id", F.col("text").alias("t"))
    # the same text with its accents as marks of their own
    apart = F.replace(F.replace(F.col("t"), F.lit("é"), F.lit("é")), F.lit("ü"), F.lit("ü"))
    return docs.select("doc_id", scalars.same_title(apart, F.col("t")).alias("same"), scalars.same_title(F.concat(apart, F.lit("​")), F.col("t")).alias("odd"))


def _warehouse(spark, name):
    """A warehouse of its own in the folder that all executors share; a temporary one only on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidegate-")
        atexit.register(shutil.rmtree, base, True)
    return Warehouse(spark, f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}")


def _nations(spark, d):
    """The venue list: the nations."""
    return [Venue(str(r.n_nationkey), r.n_name, str(r.n_regionkey), r.n_name) for r in _read(spark, d, "nation").orderBy("n_nationkey").collect()]


def q_ingest_runs(spark, d):
    """Two runs of the engine over the nations, into a warehouse of their own: its daily counts."""
    w, venues = _warehouse(spark, "ingest"), _nations(spark, d)
    for day in (date(2026, 3, 1), date(2026, 3, 4)):
        engine.run(w, venues, today=day, source=lambda x: items.synthetic(x, noise=False))
    return w.read("pageviews").select("venue_id", "article", "view_date", "views")


@functools.lru_cache(4096)
def _days_of(a: str, b: str) -> tuple[tuple[str, int], ...]:
    """The days from a to b, both YYYYMMDD, each with its number in the month."""
    a, b = date.fromisoformat(a), date.fromisoformat(b)
    days = [a + timedelta(days=i) for i in range((b - a).days + 1)]
    return tuple((day_text(x), x.day) for x in days)


class Narrow:
    """A stub of the API that answers windows of few days only: how few depends on the article."""

    def __call__(self, url):
        *_, article, _, a, b = url.split("/")
        n, days = zlib.crc32(article.encode()) % 4, _days_of(a, b)
        if len(days) > (0, 40, 7, 1)[n]:
            return (404, {}, b"") if n % 2 else (200, {}, b'{"items": []}')
        # as json.dumps would write it: a quoted title has nothing to escape
        head = f'{{"project": "{schema.PROJECT}", "article": "{article}", "granularity": "{schema.GRANULARITY}", "timestamp": "'
        tail = f'00", "access": "{schema.ACCESS}", "agent": "{schema.AGENT}", "views": '
        return 200, {}, f'{{"items": [{", ".join([f"{head}{x}{tail}{day + n}}}" for x, day in days])}]}}'.encode()


def narrow_fetch(article, start, end):
    return fetch_window(article, start, end, opener=Narrow(), sleep=lambda _: None)


def _asked(spark, d):
    """A window of 16 days for each part."""
    p = _read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("venue_id"), F.concat(F.lit("Part_"), "p_partkey").alias("article"))
    day = lambda x: F.lit(date(2026, 1, x))
    return p.select("venue_id", "article", day(3).alias("venue_start"), day(18).alias("venue_end"), day(3).alias("window_start"), day(18).alias("window_end"), F.col("venue_id").cast("long").alias("call"))


def q_fetch_windows(spark, d):
    """Fetching in tasks, with wider windows and slices: a stub that refuses wide windows in place of the API."""
    got = items.OnExecutors(narrow_fetch, parallelism=4)(_asked(spark, d))
    v = lambda f, t: F.get_json_object("raw", f"$.{f}").cast(t).alias(f)
    return got.select("venue_id", (F.col("seq") % items.CALL).alias("pos"), v("timestamp", "string"), v("views", "long"), "error")


def q_fetch_source(spark, d):
    """The nations' windows by the Python data source, over several partitions."""
    windows = [[v.venue_id, v.wiki_article, "2026-01-03", "2026-01-18"] for v in _nations(spark, d)]
    spark.dataSource.register(items.source_of(narrow_fetch, "tidegate_narrow"))
    got = spark.read.format("tidegate_narrow").option("windows", json.dumps(windows)).option("parallelism", "3").load()
    return got.select("venue_id", F.get_json_object("raw", "$.timestamp").alias("timestamp"), "error")


def _records(spark, d):
    """The events as an upstream's records: all hidden, hidden from wide questions, from just the windows' own width, in part, or not at all."""
    v, e = F.expr("cast(venue_id as int) % 5"), F.expr("seq % 3")
    low = F.when(v == 0, 1).when(v == 1, 8).when(v == 2, 10).when((v == 3) & (e == 0), 2).when(v == 4, F.when(e == 0, 4).otherwise(1))
    high = F.when(v == 2, 10).when((v == 4) & (e == 0), 12).when(low.isNotNull(), 1000)
    day = F.date_format("d", "yyyyMMdd'00'")
    raw = F.concat(F.lit('{"timestamp":"'), day, F.lit('","views":'), F.col("k").cast("string"), F.lit("}"))
    return shaped(spark, d).select("venue_id", "article", F.col("d").alias("day"), low.alias("hidden_from"), high.alias("hidden_to"), F.col("seq").alias("pos"), raw.alias("raw"))


def _verify_windows(spark, d):
    r = shaped(spark, d).groupBy("venue_id", "article").agg(F.min("d").alias("start"), F.max("d").alias("end"))
    w = planning.plan_windows(r, 10)
    call = F.col("venue_id").cast("long") * 1000 + F.col("window_no")
    return w.select("venue_id", "article", F.col("start").alias("venue_start"), F.col("end").alias("venue_end"), "window_start", "window_end", call.alias("call"))


def q_verify_requests(spark, d):
    """Every question that windows of ten days take: the window, earlier starts, halves of what is empty."""
    asks = verify.requests(verify.verified(_verify_windows(spark, d), _records(spark, d)))
    return asks.select("venue_id", "window_start", "ask_no", "kind", "ask_start", "ask_end", "n_days")


def q_verify_counts(spark, d):
    """How many questions each window takes, and what they bring."""
    asks = verify.requests(verify.verified(_verify_windows(spark, d), _records(spark, d)))
    of = lambda k: F.count_if(F.col("kind") == k)
    return asks.groupBy("venue_id", "window_start").agg(F.count(F.lit(1)).alias("n_requests"), of(verify.WIDENED).alias("n_widened"), of(verify.SLICE).alias("n_slices"))


def q_recorded_items(spark, d):
    """The items of recorded answers as a run stages them."""
    got = items.recorded(_records(spark, d))(_verify_windows(spark, d))
    return got.select("venue_id", "window_start", "seq", "raw")


def q_payload_drift(spark, d):
    """Bodies that depart from the contract, one row for each departure: broken JSON, wrong shapes, missing fields, wrong kinds."""
    s = shaped(spark, d).select("seq", "article", "stamp", "k")
    at = lambda n: F.expr(f"seq % 17 = {n}")
    text = lambda *p: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in p])
    good = text('{"project":"en.wikipedia","article":"', F.col("article"), '","granularity":"daily","timestamp":"', F.col("stamp"), '","access":"all-access","agent":"user","views":', F.col("k").cast("string"), "}")

    def body(good):
        swap = lambda a, b: F.replace(good, F.lit(a), F.lit(b))
        item = F.when(at(7), "5").when(at(8), "null").when(at(9), '"x"').when(at(10), swap('"user"', '"spider"')).when(at(11), swap('"daily"', '"hourly"')).when(at(12), swap('"all-access"', '"desktop"'))
        item = item.when(at(13), F.regexp_replace(good, '"timestamp":"([0-9]*)"', '"timestamp":$1')).when(at(14), swap('"views"', '"hits"')).otherwise(good)
        out = F.when(at(0), "{").when(at(1), "[]").when(at(2), '"x"').when(at(3), "{}").when(at(4), '{"items":null}').when(at(5), '{"items":{}}')
        out = F.encode(out.otherwise(text('{"items":[', good, ",", item, "]}")), "UTF-8")
        # a byte that UTF-8 has not
        return F.when(at(6), F.concat(F.encode(F.lit('{"items":["'), "UTF-8"), F.unhex(F.lit("FF")), F.encode(F.lit('"]}'), "UTF-8"))).otherwise(out)

    # bound once, as the contract looks at it many times
    bodies = s.select("seq", "article", F.get(F.transform(F.array(good), body), F.lit(0)).alias("body"))
    _, drift = contract.parse_bodies(bodies)
    return drift.select("seq", "pos", "message")


def q_judge_raw(spark, d):
    """Raw items with faults of every rule, judged from their JSON text."""
    s = shaped(spark, d)
    views = F.when(F.col("kind") == "str", F.concat(F.lit('"'), F.col("cnt"), F.lit('"'))).otherwise(F.col("cnt"))
    title = F.when(F.col("same"), F.col("article")).otherwise(F.concat(F.col("article"), F.lit("x")))
    raw = F.concat(F.lit('{"article":"'), title, F.lit('","timestamp":"'), F.col("stamp"), F.lit('","views":'), views, F.lit("}"))
    j = rules.judge(s.select("seq", "venue_id", "article", "window_start", "window_end", raw.alias("raw")), F.lit(_T))
    return j.select("seq", "view_date", "views", "rule", "detail")


def _poisoned(windows):
    """Every count of the nations up to 14 is negative, each night on the same days."""
    base = items.synthetic(windows, noise=False)
    bad = F.regexp_replace("raw", r'"views":(\d+)', '"views":-$1')
    return base.withColumn("raw", F.when(F.col("venue_id").cast("int") < 15, bad).otherwise(F.col("raw")))


def q_abort_and_heal(spark, d):
    """Most venues turn bad: the first night is refused but keeps its rejects, so that the second loads the others."""
    w, venues = _warehouse(spark, "heal"), _nations(spark, d)
    for _ in range(2):
        with contextlib.suppress(schema.QualityGateFailed):
            engine.run(w, venues, today=date(2026, 3, 1), backfill_days=10, source=_poisoned)
    nights = w.read("run_log").select("status", "venues", "requests", "rows_fetched", "rows_loaded", "rows_quarantined", "reject_rate", F.lit("run").alias("what"))
    none = lambda t: F.lit(None).cast(t)

    def kept(t):
        counts = w.read(t).agg(F.count(F.lit(1)).cast("int").alias("n"), F.countDistinct("venue_id").cast("int").alias("v"))
        return counts.select(none("string"), "v", none("int"), none("int"), "n", none("int"), none("double"), F.lit(t))

    return nights.union(kept("quarantine")).union(kept("pageviews"))


def q_venue_counts(spark, d):
    """count(DISTINCT column) by rule."""
    return reports.reject_breadth(_bad(judged(spark, d)))


def q_migrated_quarantine(spark, d):
    """Rejects of an older layout, without view_date, read with those of the present one."""
    w = _warehouse(spark, "old")
    bad = _bad(judged(spark, d)).select(F.lit("r").alias("run_id"), "venue_id", "article", "view_date", "rule", "detail", F.lit(None).cast("string").alias("raw"), F.lit(None).cast("timestamp_ntz").alias("seen_at"), "seq")
    m = w.manifest()
    bad.where("seq % 2 = 0").drop("view_date", "seq").write.parquet(f"{w.path}/quarantine/old")
    w._publish({**m, "version": m["version"] + 1, "quarantine": ["quarantine/old"]})
    w.commit(Commit(quarantine=bad.where("seq % 2 = 1").drop("seq")))
    return w.read("quarantine").select("venue_id", "view_date", "rule", "detail")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n[2:]: f for n, f in globals().items() if n.startswith("q_")}


_W = "WITH "


def _crc(s: str) -> str:
    """The CRC-32 of a string, which DuckDB has no function for: eight steps a byte."""
    byte = "lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    codes = rf"list_transform(string_split(rtrim(regexp_replace(hex(encode({s})), '(..)', '\1 ', 'g')), ' '), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda s, b: list_reduce(list_concat([xor(s, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {byte})), 4294967295)"


def _counted(article: str, first: str) -> str:
    """The synthetic source's count on the i-th day."""
    return f"floor((200 + {_crc(article)} % 800) * CASE WHEN isodow(DATE '{first}' + i::INT) >= 6 THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END)::BIGINT"


ORACLES = {
    "plan_windows": f"""{_W}{_SHAPED}, r AS (SELECT venue_id, min(d) AS s, max(d) AS e FROM base GROUP BY venue_id),
      w AS (SELECT venue_id, e, s, unnest(range(0, (e - s) // 7 + 1)) AS i FROM r)
      SELECT venue_id, i::INT AS window_no, (s + (7 * i)::INT) AS window_start, least(s + (7 * i)::INT + 6, e) AS window_end FROM w""",
    "start_date_for": f"{_W}{_SHAPED}, {_MARKS}, {_STORED}, {_STARTS} SELECT venue_id, current, has_rows, start FROM starts",
    "lookback_floor": f"{_W}{_SHAPED}, {_MARKS}, {_STORED}, {_STARTS} SELECT venue_id, greatest(start, DATE '2024-01-05') AS start, greatest(DATE '2024-01-05' - start, 0)::INT AS gave_up FROM starts WHERE greatest(start, DATE '2024-01-05') <= DATE '2024-01-25'",
    "parse_daily_stamp": f"{_W}{_SHAPED} SELECT seq, stamp, view_date FROM dated",
    "first_broken_rule": f"{_W}{_JUDGED} SELECT seq, view_date, views, rule, detail FROM judged",
    "one_row_per_date": f"{_W}{_JUDGED} SELECT seq, venue_id, view_date, detail FROM judged WHERE rule = 'one_row_per_date'",
    "quarantine_report": f"{_W}{_JUDGED} SELECT rule, count(DISTINCT (venue_id, view_date)) AS days, count(*) AS rejections FROM bad GROUP BY rule",
    "novel_rejects": f"{_W}{_JUDGED}, {_NOVEL} SELECT seq, venue_id, view_date, rule FROM novel",
    "held_venues": f"{_W}{_JUDGED}, {_HELD} SELECT venue_id, seen, fresh, rate, held FROM held",
    "majority_gate": f"{_W}{_JUDGED}, {_HELD} SELECT count(*) AS answering, count(*) FILTER (held) AS n_held, 2 * count(*) FILTER (held) > count(*) AS majority FROM held",
    "gate_residual": f"{_W}{_JUDGED}, {_HELD} SELECT sum(seen)::BIGINT AS gate_seen, sum(fresh)::BIGINT AS gate_fresh, sum(fresh)::DOUBLE / sum(seen)::DOUBLE AS gate_rate FROM held WHERE NOT held",
    "publication_frontier": f"{_W}{_JUDGED}, {_STORED}, o AS (SELECT max(view_date) AS observed FROM (SELECT view_date FROM stored UNION ALL SELECT view_date FROM clean) WHERE view_date <= DATE '2024-01-26') SELECT observed, CASE WHEN observed IS NOT NULL THEN least(observed, DATE '2024-01-21') END AS trusted FROM o",
    "venue_stats": f"{_W}{_JUDGED}, {_STATS} SELECT * FROM stats",
}
_FAR = f"""{_STATS}, {_MARKS},
far AS (
  SELECT stats.*, last_date, CASE WHEN unknown_bad THEN NULL ELSE least(CASE WHEN stats.venue_id LIKE '%7' THEN last_clean ELSE greatest(coalesce(last_clean, DATE '2024-01-21'), DATE '2024-01-21') END, coalesce(first_bad - 1, DATE '2024-01-26')) END AS f0,
    CASE WHEN stats.venue_id LIKE '%7' AND last_clean IS NULL THEN true ELSE false END AS none
  FROM stats LEFT JOIN marks USING (venue_id)
),
wm AS (SELECT *, CASE WHEN NOT none AND f0 >= DATE '2024-01-01' THEN f0 END AS frontier FROM far),
wm2 AS (SELECT *, CASE WHEN frontier IS NOT NULL AND (last_date IS NULL OR frontier > last_date) THEN frontier END AS new FROM wm)"""
_DAYS = "SELECT venue_id, view_date, max(views) AS views, {0} AS run FROM clean WHERE seq % 2 = {0} GROUP BY venue_id, view_date"
ORACLES |= {
    "venue_watermark": f"{_W}{_JUDGED}, {_FAR} SELECT venue_id, frontier, new FROM wm2",
    "venue_alerts": f"""{_W}{_JUDGED}, {_FAR}, {_STORED}, ls AS (SELECT venue_id, max(view_date) AS l FROM stored GROUP BY venue_id),
      v AS (SELECT c_custkey::VARCHAR AS venue_id, c_name, coalesce(n_clean, 0) AS n_clean, coalesce(n_bad, 0) AS n_bad, l, CASE WHEN l IS NULL THEN last_clean WHEN last_clean IS NULL THEN l ELSE greatest(l, last_clean) END AS last, coalesce(new, marks.last_date) AS eff
        FROM customer LEFT JOIN wm2 ON wm2.venue_id = c_custkey::VARCHAR LEFT JOIN ls ON ls.venue_id = c_custkey::VARCHAR LEFT JOIN marks ON marks.venue_id = c_custkey::VARCHAR),
      n AS (SELECT venue_id, CASE WHEN l IS NULL AND n_clean = 0 THEN venue_id || ': no rows ever' || CASE WHEN n_bad > 0 THEN ', ' || n_bad || ' row(s) rejected' ELSE '' END || ', check ''' || c_name || ''''
        WHEN DATE '2024-01-26' - last > 7 THEN venue_id || ': no rows for ' || (DATE '2024-01-26' - last) || ' days (watermark ' || coalesce(eff::VARCHAR, 'None') || '), check ''' || c_name || '''' END AS note FROM v)
      SELECT venue_id, note FROM n WHERE note IS NOT NULL""",
    "upsert_pageviews": f"{_W}{_JUDGED}, o AS ({_DAYS.format(0)}), n AS ({_DAYS.format(1)}) SELECT * FROM n UNION ALL SELECT * FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.venue_id = o.venue_id AND n.view_date = o.view_date)",
    "append_new_rejects": f"{_W}{_JUDGED}, {_NOVEL} SELECT venue_id, view_date, rule, 'old' AS written FROM bad WHERE seq % 3 = 0 UNION ALL SELECT venue_id, view_date, rule, 'new' FROM novel",
    "drop_held": f"{_W}{_JUDGED}, {_HELD} SELECT seq, clean.venue_id, view_date, views FROM clean JOIN held USING (venue_id) WHERE NOT held",
    "merge_sources": f"""{_W}{_SHAPED}, every AS (SELECT venue_id, stamp, seq AS pos FROM shaped WHERE stamp[1:8] BETWEEN '20240105' AND '20240120'),
      w AS (SELECT venue_id, stamp, pos, 0 AS src FROM every WHERE pos % 3 = 0)
      SELECT stamp, pos, src FROM w UNION ALL SELECT stamp, pos, 1 FROM every e WHERE pos % 3 <> 0 AND NOT EXISTS (SELECT 1 FROM w WHERE w.venue_id = e.venue_id AND w.stamp = e.stamp)""",
    "json_type_check": f"{_W}{_SHAPED}, {_RAW} SELECT seq, CASE json_type(raw::JSON, '$.views') WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'bool' WHEN 'VARCHAR' THEN 'str' WHEN 'ARRAY' THEN 'list' WHEN 'OBJECT' THEN 'dict' WHEN 'DOUBLE' THEN 'float' ELSE 'int' END AS kind FROM raws",
    "contract_missing_fields": f"{_W}{_SHAPED}, {_RAW} SELECT seq, CASE WHEN NOT list_contains(json_keys(raw::JSON), 'agent') THEN 'an item has no [''agent'']' ELSE 'project is de.wikipedia, not ''en.wikipedia'': this answers another question' END AS drift FROM raws WHERE NOT list_contains(json_keys(raw::JSON), 'agent') OR raw::JSON->>'$.project' <> 'en.wikipedia'",
    "url_build": "SELECT p_partkey, 'https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article/en.wikipedia/all-access/user/' || url_encode(p_name || ' (é)*~/' || p_partkey) || '/daily/20240101/20240126' AS url FROM part",
    "venue_profile": f"{_W}{_JUDGED} SELECT venue_id, count(*) AS days, round(avg(views)) AS mean_views, min(view_date) AS first_day, max(view_date) AS last_day FROM clean GROUP BY venue_id",
    "duplicate_pairs": f"{_W}{_SHAPED} SELECT count(*) AS duplicates FROM (SELECT venue_id, d FROM base GROUP BY 1, 2 HAVING count(*) > 1)",
    "totals_scalar": "SELECT (SELECT count(*) FROM events) AS total, (SELECT count(*) FROM (SELECT user_id, CAST(ts AS DATE) FROM events GROUP BY 1, 2 HAVING count(*) > 1)) AS duplicates",
    "recent_runs_topk": "SELECT o_orderkey::VARCHAR AS run_id, CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey::VARCHAR LIMIT 10",
    "stuck_venues": f"{_W}{_JUDGED}, {_FAR} SELECT venue_id, new AS last_date FROM wm2 WHERE new IS NOT NULL ORDER BY new, venue_id",
    "synthetic_weekend": f"SELECT n_name AS article, strftime(DATE '2024-01-01' + i::INT, '%Y%m%d') || '00' AS stamp, {_counted('n_name', '2024-01-01')} AS views FROM nation, range(14) r(i)",
    "backoff_clamp": "SELECT event_id, CASE WHEN event_id % 5 < 3 THEN least(pow(2.0::DOUBLE, (event_id % 9)::DOUBLE), 120.0::DOUBLE) ELSE greatest(least((event_id - 500)::DOUBLE, 120.0::DOUBLE), 0.0::DOUBLE) END AS seconds FROM events",
    "run_summary": f"""{_W}{_JUDGED}, {_HELD}, r AS (SELECT min(d) AS s, max(d) AS e FROM base GROUP BY venue_id)
      SELECT (SELECT sum((e - s) // 7 + 1)::BIGINT FROM r) AS requests, (SELECT count(*) FROM judged) AS rows_fetched, (SELECT count(*) FROM bad) AS rows_quarantined,
        (SELECT count(*) FROM clean JOIN held USING (venue_id) WHERE NOT held) AS rows_loaded, (SELECT count(*) FROM bad)::DOUBLE / (SELECT count(*) FROM judged)::DOUBLE AS reject_rate""",
    "title_nfc_match": "SELECT doc_id, nfc_normalize(replace(replace(t, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776))) = nfc_normalize(t) AS same, nfc_normalize(replace(replace(t, 'é', 'e' || chr(769)), 'ü', 'u' || chr(776)) || chr(8203)) = nfc_normalize(t) AS odd FROM (SELECT doc_id, text AS t FROM documents)",
    "ingest_runs": f"SELECT n_nationkey::VARCHAR AS venue_id, n_name AS article, CAST(DATE '2025-11-30' + i::INT AS DATE) AS view_date, {_counted('n_name', '2025-11-30')} AS views FROM nation, range(93) r(i)",
    "fetch_windows": f"""WITH a AS (SELECT p_partkey, {_crc("'Part_' || p_partkey")} % 4 AS n FROM part)
      SELECT p_partkey::VARCHAR AS venue_id, i::BIGINT AS pos, strftime(DATE '2026-01-03' + i::INT, '%Y%m%d') || '00' AS timestamp, (3 + i + n)::BIGINT AS views, NULL::VARCHAR AS error FROM a, range(16) r(i) WHERE n > 0""",
    "fetch_source": f"""WITH a AS (SELECT n_nationkey, {_crc("replace(n_name, ' ', '%20')")} % 4 AS n FROM nation)
      SELECT n_nationkey::VARCHAR AS venue_id, strftime(DATE '2026-01-03' + i::INT, '%Y%m%d') || '00' AS timestamp, NULL::VARCHAR AS error FROM a, range(16) r(i) WHERE n > 0""",
    "payload_drift": f"""{_W}{_SHAPED} SELECT seq, (CASE WHEN seq % 17 < 7 THEN -1 ELSE 1 END)::INT AS pos, article || ': ' || CASE seq % 17 WHEN 0 THEN 'the body is no UTF-8 JSON' WHEN 6 THEN 'the body is no UTF-8 JSON' WHEN 1 THEN 'the body is list, not an object' WHEN 2 THEN 'the body is str, not an object'
        WHEN 3 THEN 'the body has no ''items''' WHEN 4 THEN 'the body has no ''items''' WHEN 5 THEN '''items'' is dict, not a list' WHEN 7 THEN 'an item is int, not an object' WHEN 8 THEN 'an item is NoneType, not an object' WHEN 9 THEN 'an item is str, not an object'
        WHEN 10 THEN 'agent is spider, not ''user'': this answers another question' WHEN 11 THEN 'granularity is hourly, not ''daily'': this answers another question' WHEN 12 THEN 'access is desktop, not ''all-access'': this answers another question'
        WHEN 13 THEN 'timestamp is int, not a string' ELSE 'an item has no [''views'']' END AS message FROM shaped WHERE seq % 17 < 15""",
    "judge_raw": f"{_W}{_JUDGED} SELECT seq, view_date, views, rule, CASE WHEN rule = 'article_matches_request' THEN 'got ''' || article || 'x'', asked for ''' || article || '''' ELSE detail END AS detail FROM judged",
    "abort_and_heal": """SELECT 'failed' AS status, 25 AS venues, 25 AS requests, 250 AS rows_fetched, 0 AS rows_loaded, 150 AS rows_quarantined, 0.6::DOUBLE AS reject_rate, 'run' AS what UNION ALL SELECT 'ok', 25, 25, 250, 100, 150, 0.6::DOUBLE, 'run'
      UNION ALL SELECT NULL, 15, NULL, NULL, 300, NULL, NULL, 'quarantine' UNION ALL SELECT NULL, 10, NULL, NULL, 100, NULL, NULL, 'pageviews'""",
    "venue_counts": f"{_W}{_JUDGED} SELECT rule, count(DISTINCT venue_id) AS venues, count(DISTINCT view_date) AS days FROM bad GROUP BY rule",
    "migrated_quarantine": f"{_W}{_JUDGED} SELECT venue_id, CASE WHEN seq % 2 = 1 THEN view_date END AS view_date, rule, detail FROM bad",
}
ORACLES["run_counters"] = f"{_W}{_JUDGED} SELECT count(*) AS rows_fetched, count(*) FILTER (rule IS NOT NULL) AS rows_quarantined, max(view_date) FILTER (rule IS NULL AND view_date <= DATE '2024-01-26') AS last_clean FROM judged"
ORACLES["run_note"] = f"""WITH s AS ({_W}{_SHAPED}, {_MARKS}, {_STORED}, {_STARTS} SELECT venue_id, DATE '2024-01-05' - start AS days FROM starts WHERE start < DATE '2024-01-05'),
  a AS ({ORACLES["venue_alerts"]}), h AS ({ORACLES["held_venues"]}), c AS ({_W}{_JUDGED}, {_NOVEL} SELECT (SELECT count(*) FROM bad) AS m, (SELECT count(*) FROM novel) AS k)
  SELECT concat_ws('; ', (SELECT string_agg(venue_id || ': gave up on ' || days || ' days', '; ' ORDER BY venue_id::INT) FROM s), (SELECT string_agg(note, '; ' ORDER BY venue_id::INT) FROM a),
    (SELECT CASE WHEN m <> k THEN (m - k) || ' of ' || m || ' rejected rows were already quarantined; gate saw ' || k END FROM c),
    (SELECT string_agg(venue_id || ': ' || fresh || '/' || seen || ' newly rejected, above the ceiling, held', '; ' ORDER BY venue_id::INT) FROM h WHERE held)) AS note"""
ORACLES["novel_by_month"] = ORACLES["novel_rejects"]
ORACLES["stored_history"] = """SELECT o_custkey::VARCHAR AS venue_id, max(o_orderdate)::DATE AS last_stored, max(o_orderdate) FILTER (o_orderdate::DATE <= DATE '1995-06-17')::DATE AS last_due
  FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderdate::DATE >= DATE '1997-08-01' GROUP BY o_custkey"""
_ASKS = f"""{_SHAPED},
  recs AS (SELECT venue_id, d, seq, k, venue_id::INT % 5 AS v, seq % 3 AS e FROM shaped),
  rec AS (SELECT venue_id, d, seq, k, CASE WHEN v = 0 THEN 1 WHEN v = 1 THEN 8 WHEN v = 2 THEN 10 WHEN v = 3 AND e = 0 THEN 2 WHEN v = 4 AND e = 0 THEN 4 WHEN v = 4 THEN 1 ELSE 9999 END AS f,
    CASE WHEN v = 2 THEN 10 WHEN v = 4 AND e = 0 THEN 12 ELSE 1000 END AS t FROM recs),
  ways AS (SELECT DISTINCT venue_id, d, f, t FROM rec),
  r AS (SELECT venue_id, min(d) AS s, max(d) AS e FROM base GROUP BY venue_id),
  wi AS (SELECT venue_id, s, e, unnest(range(0, (e - s) // 10 + 1)) AS i FROM r),
  w AS (SELECT venue_id, i, (s + (10 * i)::INT) AS ws, least(s + (10 * i)::INT + 9, e) AS we FROM wi),
  node AS (
    SELECT venue_id, i, ws, we, ws AS lo, we AS hi, (SELECT count(DISTINCT d) FROM ways x WHERE x.venue_id = w.venue_id AND x.d BETWEEN ws AND we AND NOT (we - ws + 1) BETWEEN x.f AND x.t) AS n FROM w
    UNION ALL
    SELECT venue_id, i, ws, we, lo, hi, (SELECT count(DISTINCT d) FROM ways x WHERE x.venue_id = h.venue_id AND x.d BETWEEN lo AND hi AND NOT (hi - lo + 1) BETWEEN x.f AND x.t) AS n
    FROM (SELECT venue_id, i, ws, we, CASE WHEN right_half = 0 THEN lo ELSE lo + ((hi - lo + 1) // 2)::INT END AS lo, CASE WHEN right_half = 0 THEN lo + ((hi - lo + 1) // 2)::INT - 1 ELSE hi END AS hi
      FROM node, range(2) g(right_half) WHERE n = 0 AND hi > lo) h
  ),
  padded AS (SELECT node.*, p, (SELECT count(DISTINCT d) FROM ways x WHERE x.venue_id = node.venue_id AND x.d BETWEEN ws AND we AND NOT (we - ws + 1 + p) BETWEEN x.f AND x.t) AS np FROM node, (SELECT unnest([15, 30]) AS p) WHERE lo = ws AND hi = we AND n = 0),
  asks AS (
    SELECT venue_id, i, ws, we, CASE WHEN lo = ws AND hi = we THEN 'direct' ELSE 'slice' END AS kind, lo, hi, n FROM node
    UNION ALL SELECT venue_id, i, ws, we, 'widened', ws - p, we, np FROM padded a WHERE p = 15 OR NOT EXISTS (SELECT 1 FROM padded b WHERE b.venue_id = a.venue_id AND b.ws = a.ws AND b.p = 15 AND b.np > 0)
  )"""
ORACLES["verify_requests"] = f"""WITH RECURSIVE {_ASKS} SELECT venue_id, ws AS window_start, (row_number() OVER (PARTITION BY venue_id, ws ORDER BY CASE kind WHEN 'direct' THEN 0 WHEN 'widened' THEN 1 ELSE 2 END, CASE WHEN kind = 'widened' THEN ws - lo ELSE lo - ws END, hi DESC) - 1)::INT AS ask_no,
  kind, CAST(lo AS DATE) AS ask_start, CAST(hi AS DATE) AS ask_end, n::INT AS n_days FROM asks"""
ORACLES["verify_counts"] = f"WITH RECURSIVE {_ASKS} SELECT venue_id, ws AS window_start, count(*) AS n_requests, count(*) FILTER (kind = 'widened') AS n_widened, count(*) FILTER (kind = 'slice') AS n_slices FROM asks GROUP BY venue_id, ws"
ORACLES["recorded_items"] = f"""WITH RECURSIVE {_ASKS}, hit AS (SELECT a.venue_id, a.i, a.ws, rec.d, rec.seq, rec.k, a.kind, max(CASE WHEN a.kind = 'slice' THEN 0 ELSE 1 END) OVER (PARTITION BY a.venue_id, a.ws, rec.d) AS wide
    FROM asks a JOIN rec ON rec.venue_id = a.venue_id AND rec.d BETWEEN greatest(a.lo, a.ws) AND a.hi AND NOT (a.hi - a.lo + 1) BETWEEN rec.f AND rec.t)
  SELECT venue_id, ws AS window_start, (venue_id::BIGINT * 1000 + i) * 1048576 + row_number() OVER (PARTITION BY venue_id, ws ORDER BY d, seq) - 1 AS seq, '{{"timestamp":"' || strftime(d, '%Y%m%d') || '00","views":' || k || '}}' AS raw FROM hit WHERE kind <> 'slice' OR wide = 0"""
