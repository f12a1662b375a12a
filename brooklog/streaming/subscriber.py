"""Delivery of a stream of change records to a consumer.

A micro-batch is the unit that is acknowledged: its offsets are committed when the consumer has taken all of its records, and a batch that
fails, is not acknowledged or runs out of time comes again (at least once). Records go to the consumer in order of commit within a
partition; partitions are delivered one after the other on the driver if serialized, and from the tasks otherwise.
"""

from __future__ import annotations

import sys
import threading
from collections.abc import Callable
from typing import TextIO

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

Consume = Callable[[str], None]
Ack = Callable[[Exception | None], None]
ConsumeWithAck = Callable[[str, Ack], None]
ORDER = ["partition_token", "commit_timestamp", "record_sequence"]


class NackError(Exception):
    pass


class Gate:
    """Waits until n records are acknowledged; the first refusal ends it, as does the time limit (0: none)."""

    def __init__(self):
        self.changed, self.acked, self.refused = threading.Condition(), 0, None

    def acknowledge(self, error: Exception | None = None) -> None:
        with self.changed:
            self.acked += 1
            self.refused = self.refused or error
            self.changed.notify_all()

    def once(self) -> Ack:
        """The acknowledgement of one record, which counts once."""
        used = threading.Event()

        def ack(error: Exception | None = None) -> None:
            if not used.is_set():
                used.set()
                self.acknowledge(error)

        return ack

    def wait(self, n: int, timeout: float = 0) -> None:
        with self.changed:
            done = self.changed.wait_for(lambda: self.refused is not None or self.acked >= n, timeout or None)
        if self.refused is not None:
            raise NackError("a record was not acknowledged") from self.refused
        if not done:
            raise TimeoutError(f"{self.acked} of {n} records were acknowledged in {timeout} s")


def deliver(batch: DataFrame, payload: str, consumer: Consume | None, ack_consumer: ConsumeWithAck | None, ack_timeout: float) -> None:
    """The records of a batch, in order, to one of the consumers. Rows come to the driver partition by partition."""
    gate, n = Gate(), 0
    order = [c for c in ORDER if c in batch.columns]
    for row in (batch.sort(*order) if order else batch).select(payload).toLocalIterator():
        n += 1
        if consumer:
            consumer(row[0])
        else:
            ack_consumer(row[0], gate.once())
    if ack_consumer:
        gate.wait(n, ack_timeout)


def _deliver_from_tasks(batch: DataFrame, payload: str, consumer: Consume) -> None:
    keys = [c for c in ORDER if c in batch.columns]
    dealt = batch.repartition(keys[0]) if keys else batch

    def partition(rows) -> None:
        for row in rows:
            consumer(row[payload])

    (dealt.sortWithinPartitions(*keys) if keys else dealt).select(payload).foreachPartition(partition)


def subscribe(
    stream: DataFrame, checkpoint: str, consumer: Consume | None = None, ack_consumer: ConsumeWithAck | None = None, payload: str = "payload", serialized: bool = True, ack_timeout: float = 0,
    bounded: bool = False, name: str | None = None, pool: str | None = None, after_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Starts delivery. bounded: ends when all that is there has been delivered. An ack consumer's records are always serialized; after_batch runs when a batch has been taken, before it is committed."""
    if (consumer is None) == (ack_consumer is None):
        raise ValueError("one of consumer and ack_consumer must be given")
    if ack_timeout < 0:
        raise ValueError("ack_timeout must not be negative")

    def batch(df: DataFrame, number: int) -> None:
        if pool:
            df.sparkSession.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        df = df.persist() if after_batch else df
        try:
            if serialized or ack_consumer:
                deliver(df, payload, consumer, ack_consumer, ack_timeout)
            else:
                _deliver_from_tasks(df, payload, consumer)
            if after_batch:
                after_batch(df, number)
        finally:
            if after_batch:
                df.unpersist()

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def json_lines(out: TextIO | None = None) -> Consume:
    """A consumer that writes a document a line."""

    def write(document: str) -> None:
        print(document, file=out or sys.stdout, flush=True)

    return write


def json_sink(stream: DataFrame, path: str, checkpoint: str, columns: list[str] | None = None) -> StreamingQuery:
    rows = stream.select(F.to_json(F.struct(*(columns or stream.columns))).alias("value"))
    return rows.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
