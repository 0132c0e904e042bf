"""Stopping a run from another thread."""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import SparkSession

from tidegate.schema import RunCancelled


class Cancellation:
    """Handed to a run, and told ``cancel()`` by whoever wants it stopped.

    All jobs of the run bear a tag. Those under way are cancelled, and no other
    begins past the next step. A run whose commit's rename has been made is
    done and stays so. One object serves one run.
    """

    def __init__(self, spark: SparkSession, tag: str | None = None):
        self.context, self.tag, self._asked = spark.sparkContext, tag or f"tidegate-{uuid.uuid4().hex}", threading.Event()

    @property
    def asked(self) -> bool:
        return self._asked.is_set()

    def cancel(self) -> None:
        self._asked.set()
        self.context.cancelJobsWithTag(self.tag)

    def check(self) -> None:
        if self.asked:
            raise RunCancelled(f"the run tagged {self.tag} was cancelled")

    def __enter__(self) -> Cancellation:
        self.check()
        self.context.addJobTag(self.tag)
        return self

    def __exit__(self, *_: object) -> None:
        self.context.removeJobTag(self.tag)

    def settle(self, seconds: float = 60) -> bool:
        """Waits till tasks of cancelled jobs have ended, as they may still write; False if some outlive the time."""
        until = time.monotonic() + seconds
        time.sleep(0.5)  # a stage's counts are told late while it runs, and at once when it ends
        while running := self.running_tasks():
            if time.monotonic() > until:
                break
            time.sleep(0.1)
        return not running

    def running_tasks(self) -> int:
        """Tasks of the run's jobs that haven't ended."""
        tracker = self.context.statusTracker()
        jobs = [tracker.getJobInfo(j) for j in self.context._jsc.sc().statusTracker().getJobIdsForTag(self.tag)]
        stages = {s for j in jobs if j for s in j.stageIds}
        return sum(i.numActiveTasks for s in stages if (i := tracker.getStageInfo(s)))
