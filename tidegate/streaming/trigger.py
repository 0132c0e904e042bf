"""Runs driven by a stream of arriving item files.

Files of staged items (schema.ITEMS as JSON lines) are judged as they land, by
the same rules as a run's. What a rule must remember, the days that a window has
already brought, is keyed state, so however the items are cut into micro-batches
the same rows come out. Each batch is committed to the warehouse once, also if
it comes again after a failure. The batch watermark table decides what is late,
not the stream's event time, so withWatermark(), which drops late rows, isn't
used.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.window import Window

from tidegate import schema
from tidegate.operators import gate
from tidegate.operators.rules import judge, seen_before
from tidegate.plans.warehouse import Commit, Warehouse, utc_now
from tidegate.schema import QualityGateFailed

#: Where Spark keeps a stateful processor's state.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def item_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Item files of a folder as they come. Options are those of file streams, as maxFilesPerTrigger."""
    return spark.readStream.schema(schema.ITEMS).options(**options).json(path)


class FirstOfDay(StatefulProcessor):
    """Of a venue's window, the first clean row of each day stays clean; later ones break one_row_per_date.

    State: the window's days so far, each with the views first accepted. Rows of one
    batch go by seq; those of an earlier batch came first. A group is what one
    window has brought in one batch, as much as an answer may hold.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.days = handle.getMapState("days", "view_date date", "views bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:  # noqa: N802, N803
        for r in sorted(rows, key=lambda r: r.seq):
            if r.rule is None:
                day = (r.view_date,)
                if self.days.containsKey(day):
                    first = self.days.getValue(day)[0]
                    r = Row(**{**r.asDict(), "rule": schema.RULES[7], "detail": seen_before(r.view_date, first), "views": None})
                else:
                    self.days.updateValue(day, (r.views,))
            yield r

    def close(self) -> None:
        pass


def judged_stream(items: DataFrame, today: date) -> DataFrame:
    """A stream of items, judged: the rows that ``judge`` gives of them all at once, if they come in order of seq.

    A window that is asked for again, with the same first day, is the same
    window as long as the stream's checkpoint lives: state is some bytes a day
    and ends with it. (With a timeout on the clock, availableNow would never end.)
    Its query must start under STATE_STORE, as those of ``started`` do.
    """
    j = judge(items, F.lit(today), by_day=None)
    return j.groupBy("venue_id", "window_start").transformWithState(FirstOfDay(), j.schema, "append", "none")


def started(judged: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Starts what ends when all that has arrived is dealt with: trigger availableNow. The session keeps its settings; a query has its own."""
    conf, key = judged.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(key, None)
    conf.set(key, STATE_STORE)
    try:
        return judged.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def judge_stream(items: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None], today: date) -> StreamingQuery:
    """Judges what has arrived, batch by batch, and ends. sink gets the judged rows and the batch's number.

    sink must use the rows once: a second use would change the state again.
    """
    return started(judged_stream(items, today), sink, checkpoint)


def load_stream(items: DataFrame, warehouse: Warehouse, checkpoint: str, today: date, max_reject_rate: float = schema.MAX_REJECT_RATE) -> StreamingQuery:
    """Loads what has arrived into the warehouse, batch by batch, and ends.

    A batch goes through the gates of a run: rejects known to quarantine don't
    count, venues above the ceiling are held, and if most are, nothing of the
    batch is loaded but its rejects and its log, and the stream goes on. Counts,
    rejects and the log change together and once: the commit carries the stream's
    id, which the checkpoint keeps, and the batch's number. Watermarks stay; only
    a run knows that it has asked for all days.
    """
    found: list[str] = []

    def batch(df: DataFrame, n: int) -> None:
        if not found:
            found.append(json.loads(warehouse.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        load_batch(warehouse, df, (found[0], n), max_reject_rate)

    return started(judged_stream(items, today), batch, checkpoint)


def load_batch(warehouse: Warehouse, judged: DataFrame, batch: tuple[str, int], max_reject_rate: float) -> None:
    """Commits judged rows as one micro-batch of a stream.

    They are written down first, once, also if the batch stands already: that is
    what moves the stream's state.
    """
    began, run_id = utc_now(), f"{batch[0]}-{batch[1]}"
    warehouse.unstage(run_id)  # of an attempt that was cut off
    try:
        windows = F.count_distinct(F.struct("venue_id", "window_start"))
        rows = warehouse.stage(judged, run_id, "judged")
        if warehouse.committed(batch):
            return
        clean, bad = rows.where("rule is null"), rows.where("rule is not null")
        seen = rows.groupBy("venue_id").agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.col("rule").isNotNull()).alias("bad"))
        months = [r[0] for r in bad.select(gate.reject_month(F.col("view_date"))).distinct().collect()]  # one row a month
        known = warehouse.read("quarantine", months=months)
        held = warehouse.stage(gate.held_venues(seen, gate.novel_rejects(bad, known), max_reject_rate), run_id, "venues")
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        sums = held.agg(total("seen").alias("n"), total("bad").alias("n_bad"), total(F.when(~F.col("held"), F.col("seen") - F.col("bad"))).alias("loaded"))
        v = gate.verdict(held).crossJoin(sums).crossJoin(rows.agg(windows.alias("windows"))).first()  # three single rows
        log = lambda status, loaded, note: [(run_id, began, utc_now(), status, v.answering, v.windows, v.n, loaded, v.n_bad, v.n_bad / v.n if v.n else 0.0, note)]
        stamp = F.lit(began.isoformat(" ")).cast("timestamp_ntz")
        rejects = lambda df: df.select(F.lit(run_id).alias("run_id"), "venue_id", "article", "view_date", "rule", "detail", "raw", stamp.alias("seen_at"))
        try:
            gate.enforce_majority(v.answering, v.n_held, max_reject_rate)
            gate.enforce_gate(v.gate_seen, v.gate_fresh, max_reject_rate)
        except QualityGateFailed as e:
            warehouse.commit(Commit(quarantine=rejects(gate.novel_rejects(bad, known)), run_log=log("failed", 0, f"QualityGateFailed: {e}"), batch=batch))
            return
        # a day may stand in windows that overlap: the last that came counts
        last = Window.partitionBy("venue_id", "view_date").orderBy(F.desc("seq"))
        counts = gate.drop_held(clean, held).withColumn("nth", F.row_number().over(last)).where("nth = 1")
        counts = counts.select("venue_id", "article", "view_date", "views", F.lit(run_id).alias("run_id"), stamp.alias("loaded_at"))
        note = f"{v.n_held} of {v.answering} venues held" if v.n_held else ""
        warehouse.commit(Commit(pageviews=counts if v.loaded else None, quarantine=rejects(bad) if v.n_bad else None, run_log=log("ok", v.loaded, note), batch=batch))
    finally:
        warehouse.unstage(run_id)
