"""What a runner does: partitions in hand, limit, free slots, share of capacity."""

from __future__ import annotations

import logging
import threading
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from brooklog.operators.control import slots

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Metrics:
    active_partitions: int
    max_partitions: int
    available_slots: int
    capacity_percent: float

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(asdict(self).values())], "active_partitions long, max_partitions long, available_slots long, capacity_percent double")


class ActiveSet:
    """The partitions being read, for any thread. limit 0: none."""

    def __init__(self, limit: int = 0):
        if limit < 0:
            raise ValueError("limit must not be negative")
        self.limit, self._lock, self._tokens = limit, threading.Lock(), set()

    def add(self, token: str) -> None:
        with self._lock:
            self._tokens.add(token)

    def remove(self, token: str) -> None:
        with self._lock:
            self._tokens.discard(token)

    def __len__(self) -> int:
        with self._lock:
            return len(self._tokens)

    def metrics(self) -> Metrics:
        n = len(self)
        return Metrics(n, self.limit, slots(self.limit, n), -1.0 if self.limit == 0 else n / self.limit * 100.0)


class ProgressLog(StreamingQueryListener):
    """Logs a query's progress at most once in every seconds of its batches' time."""

    def __init__(self, seconds: float = 30.0):
        self.seconds, self.since, self.seen = seconds, float("inf"), []

    def onQueryStarted(self, event) -> None:
        log.info("started %s", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.since += (p.batchDuration or 0) / 1000
        self.seen.append(p.numInputRows)
        if self.since >= self.seconds:
            log.info("batch %s of %s: %s rows", p.batchId, p.name or p.id, p.numInputRows)
            self.since = 0.0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        log.info("ended %s%s", event.id, f": {event.exception}" if event.exception else "")
