"""From planned windows to staged items.

A source is called with the windows (venue_id, article, venue_start, venue_end,
window_start, window_end, call) and returns the rows of schema.ITEMS. seq orders
a run's items as they arrived: call number first, then place in the answer.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from datetime import date
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.window import Window

from tidegate import schema
from tidegate.operators import verify
from tidegate.sources.http import fetch_window

Fetch = Callable[[str, date, date], list[dict]]
#: Items of one call; a call has far fewer.
CALL = 1 << 20
_TYPES = {T.StringType(): pa.string(), T.DateType(): pa.date32(), T.LongType(): pa.int64()}
_ARROW = pa.schema([(f.name, _TYPES[f.dataType]) for f in schema.ITEMS])
_encode = json.JSONEncoder(ensure_ascii=False).encode


def _rows(fetch: Fetch, windows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows of one window after the other. A failure is a row, as a failed task would be run, and ask, again."""
    for venue_id, article, venue_start, venue_end, start, end, call in windows:
        head = (venue_id, article, venue_start, venue_end, start, end)
        try:
            items = fetch(article, start, end)
        except Exception as e:
            yield (*head, call * CALL, None, type(e).__name__, str(e))
            return
        for i, item in enumerate(items):
            raw = item if isinstance(item, str) else _encode(item)
            yield (*head, call * CALL + i, raw, None, None)


class OnExecutors:
    """Calls fetch in tasks, ``parallelism`` at a time; an API meant for one client gets 1."""

    def __init__(self, fetch: Fetch = fetch_window, parallelism: int = 1):
        self.fetch, self.parallelism = fetch, parallelism

    def __call__(self, windows: DataFrame) -> DataFrame:
        fetch = self.fetch

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = (w for b in batches for w in zip(*(c.to_pylist() for c in b.columns), strict=True))
            # all of a task's windows are one run of requests: a failure ends it
            rows = _rows(fetch, windows)
            while held := list(islice(rows, 10_000)):
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), _ARROW.types, strict=True)], schema=_ARROW)
            for _ in windows:  # unasked
                pass

        cols = windows.select("venue_id", "article", "venue_start", "venue_end", "window_start", "window_end", "call")
        dealt = cols.repartition(self.parallelism, "venue_id") if self.parallelism > 1 else cols.coalesce(1)
        return dealt.sortWithinPartitions("call").mapInArrow(run, schema.ITEMS)


class OnDriver:
    """Calls fetch on the driver, in order, and stops at the first failure: for stubs and single-client APIs."""

    def __init__(self, fetch: Fetch):
        self.fetch = fetch

    def __call__(self, windows: DataFrame) -> DataFrame:
        rows = windows.select("venue_id", "article", "venue_start", "venue_end", "window_start", "window_end", "call").orderBy("call").collect()
        return windows.sparkSession.createDataFrame(list(_rows(self.fetch, rows)), schema.ITEMS)


def synthetic(windows: DataFrame, noise: bool = True) -> DataFrame:
    """A row for each day, more at weekends; the same for the same article and day in every run."""
    day = F.col("day")
    base = 200 + F.crc32(F.encode("article", "UTF-8")) % 800
    swing = 0.8 + 0.4 * F.pmod(F.xxhash64("article", "day"), F.lit(10007)) / 10007.0 if noise else F.lit(1.0)
    views = F.floor(base * F.when(F.weekday(day) >= 5, 1.4).otherwise(1.0) * swing).cast("long")
    item = F.to_json(
        F.struct(
            F.lit(schema.PROJECT).alias("project"), "article", F.lit(schema.GRANULARITY).alias("granularity"), F.date_format(day, "yyyyMMdd'00'").alias("timestamp"),
            F.lit(schema.ACCESS).alias("access"), F.lit(schema.AGENT).alias("agent"), views.alias("views"),
        )
    )
    days = windows.select("*", F.posexplode(F.sequence("window_start", "window_end")).alias("pos", "day"))
    none = F.lit(None).cast("string")
    return days.select("venue_id", "article", "venue_start", "venue_end", "window_start", "window_end", (F.col("call") * CALL + F.col("pos")).cast("long").alias("seq"), item.alias("raw"), none.alias("error_type"), none.alias("error"))


def recorded(answers: DataFrame, pads: tuple[int, ...] = schema.VERIFY_PADS) -> Callable[[DataFrame], DataFrame]:
    """A source of recorded answers: article, day, hidden_from, hidden_to, pos and raw, asked as the API is.

    Each window takes the questions of ``verify``, all in one plan without
    Python; its items come by day, a day's by pos. Records without a day are
    in no answer.
    """

    def source(windows: DataFrame) -> DataFrame:
        head = ["venue_id", "article", "venue_start", "venue_end", "window_start", "window_end", "call"]
        days = verify.found_days(verify.verified(windows.select(*head), answers, pads))
        hidden = F.coalesce(F.col("asked_days").between(F.col("hidden_from"), F.col("hidden_to")), F.lit(False))
        got = days.join(answers.select("article", "day", "hidden_from", "hidden_to", "pos", "raw"), ["article", "day"]).where(~hidden)
        nth = F.row_number().over(Window.partitionBy("call").orderBy("day", "pos", "raw")) - 1
        none = F.lit(None).cast("string")
        return got.select(*head[:-1], (F.col("call") * CALL + nth).cast("long").alias("seq"), "raw", none.alias("error_type"), none.alias("error"))

    return source


class _Part(InputPartition):
    def __init__(self, windows: list[tuple]):
        self.windows = windows


class _Reader(DataSourceReader):
    def __init__(self, windows: list[tuple], parallelism: int, fetch: Fetch):
        self.windows, self.n, self.fetch = windows, parallelism, fetch

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for k in range(self.n) if (p := self.windows[k :: self.n])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from _rows(self.fetch, partition.windows)


class WindowsDataSource(DataSource):
    """``spark.read.format("tidegate_windows")``: option windows, JSON rows of (venue_id, article, start, end); parallelism, 1 if not given."""

    fetch: Fetch = staticmethod(fetch_window)

    @classmethod
    def name(cls) -> str:
        return "tidegate_windows"

    def schema(self):
        return schema.ITEMS

    def reader(self, schema) -> DataSourceReader:
        rows = json.loads(self.options.get("windows", "[]"))
        windows = [(v, a, (s := date.fromisoformat(x)), (e := date.fromisoformat(y)), s, e, i) for i, (v, a, x, y) in enumerate(rows)]
        return _Reader(windows, int(self.options.get("parallelism", "1")), self.fetch)


def source_of(fetch_one: Fetch, format_name: str) -> type[DataSource]:
    """A data source like WindowsDataSource that asks ``fetch_one``, under a name of its own."""

    class Own(WindowsDataSource):
        fetch = staticmethod(fetch_one)

        @classmethod
        def name(cls) -> str:
            return format_name

    return Own


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WindowsDataSource)
