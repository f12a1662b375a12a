"""The cursor of each partition as state of a streaming query: its watermark, and the children that it has told of."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "partition_token string, watermark timestamp, n_records long"


class Cursor(StatefulProcessor):
    """Rows of partition_token, event_timestamp (data and heartbeats alike). The watermark never goes back; an empty or older fetch leaves it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("cursor", "watermark timestamp, n_records long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark, n = self.state.get() if self.state.exists() else (None, 0)
        for part in rows:
            newest = part["event_timestamp"].max()
            n += int(part["is_data"].sum())
            if not pd.isna(newest) and (mark is None or newest > pd.Timestamp(mark)):
                mark = newest.to_pydatetime()
        self.state.update((mark, n))
        yield pd.DataFrame({"partition_token": [key[0]], "watermark": [mark], "n_records": [n]})

    def close(self) -> None:
        pass


def cursors(events: DataFrame) -> DataFrame:
    """A row for each partition in each micro-batch that has rows of it. The session's state store must be RocksDB."""
    return events.groupBy("partition_token").transformWithStateInPandas(Cursor(), OUTPUT, "Update", "None")
