"""Operators over small frames, and the frames of sources."""

import json
from datetime import date, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate import schema
from tidegate.functions import scalars
from tidegate.operators import frontier, gate, merge, planning, rules
from tidegate.plans import queries
from tidegate.schema import QualityGateFailed
from tidegate.sources import contract, items

TODAY = date(2026, 2, 10)
START, END = date(2026, 1, 1), date(2026, 1, 31)
A = "Milford_Sound"


def raw(day="2026010500", article=A, views="120"):
    return f'{{"project":"en.wikipedia","article":{json.dumps(article)},"granularity":"daily","timestamp":{json.dumps(day)},"access":"all-access","agent":"user","views":{views}}}'


def judge(spark, raws, article=A, today=TODAY):
    df = spark.createDataFrame([("v", article, START, END, i, r) for i, r in enumerate(raws)], "venue_id string, article string, window_start date, window_end date, seq long, raw string")
    return rules.judge(df, F.lit(today)).orderBy("seq").collect()


CASES = [
    (raw(), None), (raw(views="-4"), "views_non_negative"), (raw(views='"120"'), "views_is_integer"), (raw(views="true"), "views_is_integer"), (raw(views="null"), "views_is_integer"),
    (raw(views="120.0"), "views_is_integer"), (raw(views="1e2"), "views_is_integer"), (raw(views="[1]"), "views_is_integer"), (raw(views="{}"), "views_is_integer"),
    (raw("2025120100"), "date_in_requested_window"), (raw("2026-01-01"), "timestamp_parses"), (raw(article="Doubtful_Sound"), "article_matches_request"),
    (raw("2026010600", views="0"), None), (raw("2026010700", views="-0"), None), (raw("2026010800", views=str(2**63)), "views_within_bigint"), (raw("2026010800", views="9" * 61), "views_within_bigint"), (raw("2026010900", views=str(2**63 - 1)), None),
    (raw(article=None), "article_matches_request"), (raw(article=123), "article_matches_request"), (raw(article=[A]), "article_matches_request"),
    *[(raw(s), "timestamp_parses") for s in ("2026031012", "2026031001", "202603100", "20260310AB", "", "2026023000", "0000010100", "2026010100\n", "٢٠٢٦٠١٠١00")],
    (raw("2026-01-01", article="X"), "article_matches_request"),
]


def test_rules(spark):
    got = judge(spark, [r for r, _ in CASES])
    for (r, rule), g in zip(CASES, got, strict=True):
        assert g.rule == rule, (r, g)
        assert (g.views is None) == (rule is not None) and (g.detail is None) == (rule is None)
    assert [g.view_date for g in got if g.rule == "timestamp_parses"] == [None] * 10
    assert got[9].view_date == date(2025, 12, 1) and got[-1].view_date is None
    assert [g.detail for g in got[1:6]] == ["got -4", "got str '120'", "got bool true", "got NoneType None", "got float 120.0"]


def test_future_and_order_of_rules(spark):
    got = judge(spark, [raw("2026012000"), raw("2026030100")], today=date(2026, 1, 10))
    assert [g.rule for g in got] == ["date_not_in_future", "date_in_requested_window"]


def test_first_of_a_day_stays(spark):
    got = judge(spark, [raw(views="-1"), raw(views="100"), raw(views="999"), raw(views="100")])
    assert [g.rule for g in got] == ["views_non_negative", None, "one_row_per_date", "one_row_per_date"]
    assert got[2].detail == "2026-01-05 already seen with 100 views"


def test_titles_equal_up_to_nfc_only(spark):
    nfc, nfd = "Tūrangi", "Tūrangi"
    got = judge(spark, [raw(article=nfd), raw("2026010600", article="Taupō"), raw("2026010700", article=nfc + "­")], article=nfc)
    assert [g.rule for g in got] == [None, "article_matches_request", "article_matches_request"]
    assert "\\u016b" in got[1].detail and "\\u014d" in got[1].detail


def test_plan(spark):
    v = spark.createDataFrame([("new",), ("known",), ("empty",), ("now",), ("old",)], "venue_id string")
    end = date(2026, 2, 27)
    marks = spark.createDataFrame([("known", date(2026, 2, 20)), ("empty", date(2026, 2, 20)), ("now", end), ("old", date(2025, 1, 1))], "venue_id string, last_date date")
    stored = spark.createDataFrame([("known",), ("known",), ("now",), ("old",)], "venue_id string")
    p = planning.plan_starts(v, marks, stored, F.lit(end), F.lit(end - timedelta(days=179)), 90)
    got = {r.venue_id: r for r in p.collect()}
    assert got["new"].start == end - timedelta(days=89) and got["known"].start == date(2026, 2, 21)
    assert got["empty"].start == end - timedelta(days=89) and got["now"].start > end
    assert got["old"].gave_up == (end - timedelta(days=179) - date(2025, 1, 2)).days and got["old"].start == end - timedelta(days=179)
    w = planning.plan_windows(p.withColumn("end", F.lit(end)), 30).where("venue_id in ('new', 'now')").orderBy("window_start").collect()
    assert [(x.window_end - x.window_start).days + 1 for x in w] == [30, 30, 30] and w[-1].window_end == end
    with pytest.raises(ValueError):
        planning.plan_windows(p, 0)


def test_novelty_is_null_safe(spark):
    s = "venue_id string, view_date date, rule string"
    bad = spark.createDataFrame([("a", None, "r"), ("a", START, "r"), ("a", START, "q"), ("b", None, "r"), ("b", None, "r")], s)
    q = spark.createDataFrame([("a", None, "r"), ("a", START, "r")], s)
    assert sorted((r.venue_id, r.rule) for r in gate.novel_rejects(bad, q).collect()) == [("a", "q"), ("b", "r"), ("b", "r")]


def test_ceiling_is_strict_and_majority_counts_answering_venues(spark):
    seen = spark.createDataFrame([("a", 20), ("b", 20), ("c", 0)], "venue_id string, seen long")
    novel = spark.createDataFrame([("a",)] + [("b",)] * 2, "venue_id string")
    h = gate.held_venues(seen, novel, 0.05)
    assert {r.venue_id: r.held for r in h.collect()} == {"a": False, "b": True, "c": False}
    v = gate.verdict(h).first()
    assert (v.answering, v.n_held, v.majority, v.gate_seen, v.gate_fresh) == (2, 1, False, 20, 1)


def test_gate():
    assert gate.enforce_gate(0, 0, 0.05) == 0.0 and gate.enforce_gate(100, 5, 0.05) == 0.05
    with pytest.raises(QualityGateFailed, match="Nothing was loaded"):
        gate.enforce_gate(100, 6, 0.05)
    with pytest.raises(QualityGateFailed):
        gate.enforce_majority(3, 2, 0.05)
    gate.enforce_majority(4, 2, 0.05)


@pytest.mark.parametrize(
    "last_clean,first_bad,unknown,trusted,want",
    [
        (20, None, False, 10, 20), (5, None, False, 10, 10), (None, None, False, 10, 10), (None, None, False, None, None), (20, None, False, None, 20),
        (20, 8, False, 10, 7), (20, 1, False, 10, None), (20, None, True, 10, None), (None, None, False, 40, 31), (2, 25, False, 10, 10),
    ],
)
def test_frontier(spark, last_clean, first_bad, unknown, trusted, want):
    d = lambda n: F.lit(None).cast("date") if n is None else F.lit(date(2026, 1, 1) + timedelta(days=n - 1))
    got = spark.range(1).select(frontier.venue_frontier(F.lit(START), F.lit(END), d(trusted), d(last_clean), d(first_bad), F.lit(unknown)).alias("x")).first().x
    assert got == (None if want is None else date(2026, 1, 1) + timedelta(days=want - 1))


def test_trust_needs_evidence_and_marks_never_go_back(spark):
    none = F.lit(None).cast("date")
    r = spark.range(1).select(
        frontier.trusted_end(none, F.lit(START)).alias("a"), frontier.trusted_end(F.lit(END), F.lit(START)).alias("b"),
        frontier.advance(F.lit(START), F.lit(END)).alias("c"), frontier.advance(F.lit(START), F.lit(START)).alias("d"), frontier.advance(F.lit(END), none).alias("e"),
    ).first()
    assert tuple(r) == (None, START, None, None, END)


def test_merge(spark):
    s = "stamp string, pos int"
    wide = spark.createDataFrame([("2026010300", 0), ("2026010300", 1), ("2025123100", 2)], s)
    cut = spark.createDataFrame([("2026010300", 0), ("2026010400", 1), ("soon", 2)], s)
    got = merge.merge_sources(wide, cut, F.lit(START), F.lit(END)).orderBy("stamp", "src", "pos").collect()
    assert [(r.stamp, r.src, r.pos) for r in got] == [("2026010300", 0, 0), ("2026010300", 0, 1), ("2026010400", 1, 1), ("soon", 1, 2)]


def test_merge_keeps_requests_apart(spark):
    s = "venue_id string, stamp string, pos int"
    wide = spark.createDataFrame([("a", "2026010300", 0)], s)
    cut = spark.createDataFrame([("a", "2026010300", 1), ("b", "2026010300", 2), ("b", "2026010300", 3)], s)
    got = merge.merge_sources(wide, cut, F.lit(START), F.lit(END), ["venue_id"]).orderBy("pos").collect()
    assert [(r.venue_id, r.src, r.pos) for r in got] == [("a", 0, 0), ("b", 1, 2), ("b", 1, 3)]


def test_merge_query_takes_every_venue(spark):
    d = "/root/testdata/sf0.001"
    rows = [r for r in queries.shaped(spark, d).select("venue_id", "stamp", "seq").collect() if "20240105" <= r.stamp[:8] <= "20240120"]
    wide = {(r.venue_id, r.stamp) for r in rows if r.seq % 3 == 0}
    want = sorted((r.stamp, r.seq, int(r.seq % 3 > 0)) for r in rows if r.seq % 3 == 0 or (r.venue_id, r.stamp) not in wide)
    got = sorted((r.stamp, r.pos, r.src) for r in queries.q_merge_sources(spark, d).collect())
    assert got == want and len({r.venue_id for r in rows}) > 1


def test_titles_are_compared_whole(spark, tmp_path, monkeypatch):
    rows = [(1, "plain\nr\u00e9sum\u00e9"), (2, "plain\nplain"), (3, "\u00fcber\nplain"), (4, None), (5, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ask = lambda: [tuple(r) for r in queries.q_title_nfc_match(spark, str(tmp_path)).orderBy("doc_id").collect()]
    assert ask() == [(1, True, False), (2, True, False), (3, True, False), (4, None, None), (5, True, False)]
    monkeypatch.setattr(scalars, "same_title", lambda got, asked: got == asked)
    assert [r[1] for r in ask()] == [False, True, False, None, True]  # what lies after line 1 is seen


def test_long_titles_reach_python_in_bounded_batches(spark, tmp_path, monkeypatch):
    spark.range(0, 200, 1, 1).selectExpr("id as doc_id", "concat(repeat('\u00e9', 100000), id) as text").write.parquet(f"{tmp_path}/documents.parquet")

    @F.arrow_udf("boolean")
    def same(got: pa.Array, asked: pa.Array) -> pa.Array:
        assert got.nbytes + asked.nbytes < 32 << 20, "all 200 texts at once are 100 MB"
        return pa.array([True] * len(got), pa.bool_())

    monkeypatch.setattr(scalars, "_same_nfc", same)
    assert queries.q_title_nfc_match(spark, str(tmp_path)).where("same and odd").count() == 200


def test_scalars(spark):
    r = spark.range(1).select(
        scalars.reject_rate(F.lit(0), F.lit(0)).alias("a"), scalars.reject_rate(F.lit(1), F.lit(4)).alias("b"), scalars.url_quote(F.lit("é *~/(a)")).alias("c"),
        scalars.build_url(F.lit("x"), F.lit(END), F.lit(START)).alias("d"),
    ).first()
    assert tuple(r) == (0.0, 0.25, "%C3%A9%20%2A~%2F%28a%29", None)


def test_contract_over_bodies(spark):
    good = json.dumps({"items": [json.loads(raw()), json.loads(raw("2026010600"))], "more": 1}).encode()
    bodies = [good, b"\xff", b"{", b"[]", b"{}", b'{"items":null}', b'{"items":{}}', b'{"items":[5]}', b'{"items":[{}]}', good.replace(b"en.wiki", b"de.wiki"), b'{"items":[]}', good.replace(b'"2026010500"', b"5")]
    df = spark.createDataFrame([(i, A, bytearray(b)) for i, b in enumerate(bodies)], "n int, article string, body binary")
    got, drift = contract.parse_bodies(df)
    assert sorted((r.n, r.pos) for r in got.collect()) == [(0, 0), (0, 1), (11, 1)]
    assert rules.judge(got.where("n = 0").selectExpr("'v' venue_id", "article", "date'2026-01-01' window_start", "date'2026-01-31' window_end", "cast(pos as long) seq", "raw"), F.lit(TODAY)).where("rule is null").count() == 2
    by = {}
    for r in drift.collect():
        by.setdefault(r.n, []).append(r.message)
    assert sorted(by) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 11] and all(m.startswith(A + ": ") for ms in by.values() for m in ms)
    assert "'items' is dict" in by[6][0] and "an item is int" in by[7][0] and "['access', 'agent'" in by[8][0] and "de.wikipedia" in by[9][0] and "timestamp is int" in by[11][0]


def test_data_source(spark):
    items.register(spark)
    # no network here: what comes back is the failure, as a row
    df = spark.read.format("tidegate_windows").option("windows", json.dumps([["v", A, "2026-01-31", "2026-01-01"]])).load()
    r = df.first()
    assert df.schema == schema.ITEMS and r.error_type == "ValueError"


def test_synthetic_is_the_same_again(spark):
    w = spark.createDataFrame([("v", A, START, END, START, END, 3)], "venue_id string, article string, venue_start date, venue_end date, window_start date, window_end date, call long")
    a, b = (items.synthetic(w).orderBy("seq").collect() for _ in range(2))
    assert a == b and len(a) == 31 and [r.rule for r in judge(spark, [x.raw for x in a])] == [None] * 31


def test_queries_have_sql(spark):
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len([x for x in q if not x.startswith(("op", "pipe"))]) >= 30
