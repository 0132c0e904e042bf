"""The HTTP client against stub servers; the venue list; the contract."""

import io
import json
import urllib.error
from datetime import date, timedelta
from email.message import Message

import pytest

from tidegate import schema
from tidegate.schema import ApiError, SchemaDriftError
from tidegate.sources import http
from tidegate.sources.dimension import read_venues
from tidegate.sources.http import WindowClient, backoff_seconds, build_url, fetch_window, http_get, parse_response

A, START, END = "Sky_Tower", date(2026, 1, 1), date(2026, 1, 30)


def item(day, article=A, **more):
    return {"project": "en.wikipedia", "article": article, "granularity": "daily", "timestamp": f"{day:%Y%m%d}00", "access": "all-access", "agent": "user", "views": 5, **more}


def body(items):
    return json.dumps({"items": items}).encode()


def days(a, b):
    return [a + timedelta(days=i) for i in range((b - a).days + 1)]


class Server:
    """answer(start, end) -> list of items, None for 404, or a status."""

    def __init__(self, answer):
        self.answer, self.asked = answer, []

    def __call__(self, url):
        a, b = (date(int(x[:4]), int(x[4:6]), int(x[6:])) for x in url.split("/")[-2:])
        self.asked.append((a, b))
        got = self.answer(a, b)
        if got is None:
            return 404, {}, b""
        return (got, {}, b"") if isinstance(got, int) else (200, {}, body(got))


def ask(server, start=START, end=END, **how):
    return fetch_window(A, start, end, opener=server, sleep=lambda s: None, **how)


def test_items_that_are_no_objects(spark):
    """A string may hold the text of an object, and is none; numbers keep their spelling."""
    from tidegate.sources.contract import parse_bodies

    good = json.dumps(item(START)).replace('"views": 5', '"views": 120.0')
    for odd, kind in (("null", "NoneType"), ("5", "int"), ('"x"', "str"), (json.dumps(good), "str"), ("[1]", "list"), ("true", "bool"), ("1.5", "float")):
        df = spark.createDataFrame([(A, f'{{"items": [{good}, {odd}]}}'.encode())], "article string, body binary")
        items, drift = parse_bodies(df)
        assert [(r.pos, r.message) for r in drift.collect()] == [(1, f"{A}: an item is {kind}, not an object")]
        assert '"views":120.0' in items.first().raw.replace(" ", "")


def test_url():
    assert build_url("Sky_Tower_(Auckland)/é ~*", START, END).endswith("/en.wikipedia/all-access/user/Sky_Tower_%28Auckland%29%2F%C3%A9%20~%2A/daily/20260101/20260130")
    with pytest.raises(ValueError):
        build_url(A, END, START)


def test_direct_answer_is_one_request_and_untrimmed():
    s = Server(lambda a, b: [item(d) for d in days(a, b)] + [item(date(2020, 1, 1))])
    assert len(ask(s)) == 31 and len(s.asked) == 1


@pytest.mark.parametrize("nothing", [None, []])
def test_nothing_anywhere_costs_2n_plus_1(nothing):
    for n in (1, 2, 7, 30):
        s = Server(lambda a, b: nothing)
        assert ask(s, START, START + timedelta(days=n - 1)) == []
        assert len(s.asked) == 2 * n + 1


def test_a_window_quotes_its_title_once(monkeypatch):
    """The 61 questions of a silent window share what they begin with."""
    quote, quoted = http.urllib.parse.quote, []
    monkeypatch.setattr(http.urllib.parse, "quote", lambda *x, **y: quoted.append(x[0]) or quote(*x, **y))
    s = Server(lambda a, b: None)
    assert fetch_window("Quoted once/é", START, END, opener=s, sleep=lambda _: None) == [] and len(s.asked) == 61
    assert quoted == ["Quoted once/é"]


def test_only_the_exact_window_refused():
    s = Server(lambda a, b: None if (a, b) == (START, END) else [item(d) for d in days(a, b)])
    got = ask(s)
    assert [g["timestamp"][:8] for g in got] == [f"{d:%Y%m%d}" for d in days(START, END)] and len(s.asked) == 4


def test_only_short_slices_answer():
    s = Server(lambda a, b: None if (b - a).days + 1 > 7 else [item(d) for d in days(a, b)])
    assert len(ask(s)) == 30 and len(s.asked) == 13


def test_pad_that_brings_only_other_days_goes_on_to_the_next():
    def answer(a, b):
        if a == START - timedelta(days=15):
            return [item(START - timedelta(days=3))]
        return [item(START + timedelta(days=2))] if a == START - timedelta(days=30) else None

    s = Server(answer)
    assert [g["timestamp"] for g in ask(s)] == ["2026010300"]


def test_repeats_within_an_answer_stay_in_order_and_sources_do_not_repeat():
    twice = [item(date(2026, 1, 3), views=1), item(date(2026, 1, 3), views=2)]
    s = Server(lambda a, b: None if (a, b) == (START, END) else twice if a < START else [item(d, views=9) for d in days(a, b)])
    got = ask(s)
    assert len(got) == 31 and [g["views"] for g in got if g["timestamp"] == "2026010300"] == [1, 2]


def test_odd_stamps_are_kept_for_the_rules():
    odd = item(START, timestamp="soon")
    s = Server(lambda a, b: None if (a, b) == (START, END) else [odd])
    assert odd in ask(s)


def test_retries_then_gives_up():
    waits = []
    calls = []

    def down(url):
        calls.append(url)
        return 503, {"RETRY-after": "7"}, b""

    with pytest.raises(ApiError, match="status 503 at request 4 of at most 4"):
        fetch_window(A, START, END, opener=down, sleep=waits.append)
    assert len(calls) == 4 and waits == [7.0, 7.0, 7.0]
    with pytest.raises(ApiError, match="status 403 at request 1 of"):
        fetch_window(A, START, END, opener=lambda u: (403, {}, b""), sleep=waits.append)


@pytest.mark.parametrize("value,low,high", [("30", 30, 30), ("-5", 0, 0), ("1e9", 120, 120), ("inf", 2, 2.5), ("nan", 2, 2.5), ("Wed, 21 Oct", 2, 2.5), (None, 2, 2.5)])
def test_backoff(value, low, high):
    assert low <= backoff_seconds(1, {} if value is None else {"Retry-After": value}) <= high


def test_backoff_is_bounded():
    assert backoff_seconds(30, {}) == schema.MAX_BACKOFF_SECONDS == 120.0


def test_fixed_values():
    assert (schema.CHUNK_DAYS, schema.BACKFILL_DAYS, schema.MAX_REJECT_RATE, schema.MAX_LOOKBACK_DAYS, schema.PUBLICATION_LAG_DAYS, schema.TRUST_LAG_DAYS) == (30, 90, 0.05, 180, 2, 7)
    assert (schema.VERIFY_PADS, schema.MAX_ATTEMPTS, schema.MAX_RESPONSE_BYTES, schema.VIEWS_MAX, schema.TRANSPORT_STATUS) == ((15, 30), 4, 2097152, 9223372036854775807, 599)


@pytest.mark.parametrize(
    "payload",
    [b"\xff", b"{", b"\xef\xbb\xbf{}", b"[]", b'"x"', b"5", b"{}", b'{"items":null}', b'{"items":{}}', b'{"items":[5]}', b'{"items":[null]}', body([{"project": "en.wikipedia"}]), body([item(START, project="de.wikipedia")]), body([item(START, granularity="monthly")]), body([item(START, access="desktop")]), body([item(START, agent="spider")]), body([item(START, timestamp=2026010100)])],
)
def test_drift(payload):
    with pytest.raises(SchemaDriftError, match=A):
        parse_response(payload, A)


def test_extra_and_null_fields_are_no_drift():
    assert len(parse_response(body([item(START, more=1), item(START, article=None, views=None)]), A)) == 2


class Reply(io.BytesIO):
    status, headers = 200, {"X": "y"}


def test_http_get(monkeypatch):
    def answer(what):
        def urlopen(request, timeout):
            assert timeout == 30 and request.get_header("User-agent")
            if isinstance(what, Exception):
                raise what
            return what

        monkeypatch.setattr(http.urllib.request, "urlopen", urlopen)
        return http_get("https://x/y")

    assert answer(Reply(b"ok")) == (200, {"X": "y"}, b"ok")
    bad = urllib.error.HTTPError("u", 404, "no", Message(), io.BytesIO(b"gone"))
    assert answer(bad)[::2] == (404, b"gone") and bad.fp.closed
    for e in (urllib.error.URLError("x"), TimeoutError(), ConnectionResetError(), http.http.client.IncompleteRead(b"")):
        assert answer(e) == (599, {}, b"")
    assert answer(Reply(b"x" * schema.MAX_RESPONSE_BYTES))[0] == 200
    with pytest.raises(ApiError):
        answer(Reply(b"x" * (schema.MAX_RESPONSE_BYTES + 1)))


def test_client_counts_requests():
    c = WindowClient(opener=Server(lambda a, b: [item(a)]), sleep=lambda s: None)
    c.fetch(A, START, END)
    assert c.requests == 1


HEADER = "venue_id,venue_name,region,wiki_article\n"


def write(tmp_path, text):
    p = tmp_path / "venues.csv"
    p.write_bytes(text if isinstance(text, bytes) else text.encode())
    return p


def test_venues(tmp_path):
    v = read_venues(write(tmp_path, b"\xef\xbb\xbf" + "venue_id,notes,venue_name,region,wiki_article,,\n a ,n,A,R,Tūrangi,,\n\nb\t,,B,R,B,,\n".encode()))
    assert [(x.venue_id, x.wiki_article) for x in v] == [("a", "Tūrangi"), ("b", "B")]
    assert read_venues(write(tmp_path, HEADER + "ū,A,R,X\n"))[0].venue_id == "ū"


@pytest.mark.parametrize(
    "text,says",
    [("venue_id,venue_name,region\n", "wiki_article"), ("venue_id,venue_id,venue_name,region,wiki_article\n", "more than once"), (HEADER, "no venues"), (HEADER + "a,A,R,X\nb, ,R,X\n", "line 3.*venue_name"), (HEADER + "a,A,R,X\na,B,R,Y\n", "line 3.*line 2"), (HEADER + "a,A\n", "region")],
)
def test_bad_venues(tmp_path, text, says):
    with pytest.raises(ValueError, match=says):
        read_venues(write(tmp_path, text))
