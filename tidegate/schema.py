"""Table schemas, limits and the contract's fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Defaults and limits.
CHUNK_DAYS = 30
BACKFILL_DAYS = 90
MAX_REJECT_RATE = 0.05
MAX_LOOKBACK_DAYS = 180
PUBLICATION_LAG_DAYS = 2
TRUST_LAG_DAYS = 7
VERIFY_PADS = (15, 30)
MAX_ATTEMPTS = 4
MAX_BACKOFF_SECONDS = 120.0
MAX_RESPONSE_BYTES = 2 * 1024 * 1024
SOCKET_TIMEOUT_SECONDS = 30
RETRYABLE_STATUS = frozenset({429, 500, 502, 503, 504})
TRANSPORT_STATUS = 599
VIEWS_MAX = 2**63 - 1

# What a response must say about itself, in the order of the checks.
API_ROOT = "https://wikimedia.org/api/rest_v1/metrics/pageviews/per-article"
PROJECT = "en.wikipedia"
ACCESS = "all-access"
AGENT = "user"
GRANULARITY = "daily"
DESCRIPTORS = (("project", PROJECT), ("granularity", GRANULARITY), ("access", ACCESS), ("agent", AGENT))
FIELDS = ("project", "article", "granularity", "timestamp", "access", "agent", "views")

#: Row rules; the first that a row breaks names it.
RULES = (
    "article_matches_request",
    "timestamp_parses",
    "date_in_requested_window",
    "date_not_in_future",
    "views_is_integer",
    "views_non_negative",
    "views_within_bigint",
    "one_row_per_date",
)

VENUE_COLUMNS = ("venue_id", "venue_name", "region", "wiki_article")


def _struct(**fields: tuple[T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, (t, nullable) in fields.items()])


_S, _D, _L, _I, _TS, _F = T.StringType(), T.DateType(), T.LongType(), T.IntegerType(), T.TimestampNTZType(), T.DoubleType()
VENUES = _struct(venue_id=(_S, False), venue_name=(_S, False), region=(_S, False), wiki_article=(_S, False), ord=(_I, False))
PAGEVIEWS = _struct(venue_id=(_S, True), article=(_S, True), view_date=(_D, True), views=(_L, True), run_id=(_S, True), loaded_at=(_TS, True))
QUARANTINE = _struct(run_id=(_S, True), venue_id=(_S, True), article=(_S, True), view_date=(_D, True), rule=(_S, True), detail=(_S, True), raw=(_S, True), seen_at=(_TS, True))
WATERMARK = _struct(venue_id=(_S, True), last_date=(_D, True), updated_at=(_TS, True))
RUN_LOG = _struct(
    run_id=(_S, True), started_at=(_TS, True), finished_at=(_TS, True), status=(_S, True), venues=(_I, True), requests=(_I, True),
    rows_fetched=(_I, True), rows_loaded=(_I, True), rows_quarantined=(_I, True), reject_rate=(_F, True), note=(_S, True),
)
#: A staged item: whose, for which days asked, and its JSON text as it came.
ITEMS = _struct(
    venue_id=(_S, True), article=(_S, True), venue_start=(_D, True), venue_end=(_D, True), window_start=(_D, True), window_end=(_D, True),
    seq=(_L, True), raw=(_S, True), error_type=(_S, True), error=(_S, True),
)
#: A venue's stored days of one month, from its first day on: bit k - 1 of ``days`` stands for day k.
HISTORY = _struct(venue_id=(_S, True), first=(_D, True), days=(_L, True))
TABLES = {"pageviews": PAGEVIEWS, "quarantine": QUARANTINE, "watermark": WATERMARK, "run_log": RUN_LOG}


class QualityGateFailed(RuntimeError):
    """Too much of a run was rejected; nothing of it may load."""


class RunCancelled(RuntimeError):
    """A run that was told to stop; it leaves nothing, its log included."""


class ApiError(RuntimeError):
    """The API's answer can't be had, or means to stop asking."""


class SchemaDriftError(RuntimeError):
    """A payload no longer fits the contract."""


@dataclass(frozen=True)
class Venue:
    venue_id: str
    venue_name: str
    region: str
    wiki_article: str


@dataclass
class RunSummary:
    run_id: str
    status: str
    venues: int
    requests: int = 0
    rows_fetched: int = 0
    rows_loaded: int = 0
    rows_quarantined: int = 0
    reject_rate: float = 0.0
    note: str = ""
