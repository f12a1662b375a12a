"""A streaming source that reads a partitioned change log, with an offset for each partition.

The log is Parquet with columns partition_token, commit_timestamp and payload columns, partitioned on disk by partition_token (a folder
for each). A partition's records are in the order of commit time and record sequence. The offset is {token: [microseconds, sequence]}, the
last record up to which a partition has been planned, so a restart resumes each partition on its own, and a record that comes later
with the same commit time is delivered. Options: path, startTimestamp, endTimestamp (inclusive, ISO), maxPartitionsPerTrigger (0: all),
stepSeconds (event time that a partition advances in one micro-batch, from its first commit if no start is given; 0: to its end).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "partition_token string, commit_timestamp timestamp, record_sequence string, payload string"
END = "9999-12-31T23:59:59.999999"


def micros(at: str) -> int:
    whole = datetime.fromisoformat(at.replace("Z", "+00:00"))
    whole = whole if whole.tzinfo else whole.replace(tzinfo=timezone.utc)
    return (whole - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


class Slice(InputPartition):
    """A partition's records after low, up to high: each a time and a sequence; high's sequence may be None, for any."""

    def __init__(self, token: str, low: tuple, high: tuple):
        super().__init__(None)
        self.token, self.low, self.high = token, tuple(low), tuple(high)


class _Reader:
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}  # Spark gives them in lower case
        self.path = options["path"]
        self.start, self.end = micros(options.get("starttimestamp", "0001-01-01")), micros(options.get("endtimestamp", END))
        self.most, self.step = int(options.get("maxpartitionspertrigger", 0)), int(float(options.get("stepseconds", 0)) * 1e6)

    def tokens(self) -> list[str]:
        """The partitions there are now; children appear as their folders do."""
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(x.base_name.partition("=")[2] for x in found if x.base_name.startswith("partition_token="))

    def data(self, token: str) -> ds.Dataset:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(self.path)
        return ds.dataset(f"{root}/partition_token={token}", format="parquet", filesystem=store)

    def span(self, token: str) -> tuple[int, int] | None:
        """The first and the last commit, from the footers alone where they have them."""
        found = []
        for piece in self.data(token).get_fragments():
            for group in piece.row_groups:
                if group.num_rows and (stats := group.statistics) and "commit_timestamp" in stats:
                    found += [micros(str(stats["commit_timestamp"][k])) for k in ("min", "max")]
                elif group.num_rows:
                    ends = pa.compute.min_max(piece.subset(row_group_ids=[group.id]).to_table(columns=["commit_timestamp"]).column(0)).as_py()
                    found += [micros(str(x)) for x in ends.values() if x is not None]
        return (min(found), max(found)) if found else None

    def sequence(self, token: str, at: int) -> str:
        """The last sequence of a commit time; empty if there is none."""
        rows = self.data(token).to_table(columns=["record_sequence"], filter=ds.field("commit_timestamp") == pa.scalar(at, pa.timestamp("us")))
        return pa.compute.max(rows.column(0)).as_py() or ""

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        at = ds.field("commit_timestamp")
        kind = pa.timestamp("us")
        (low, after), (high, to) = ((pa.scalar(x, kind), y) for x, y in (partition.low, partition.high))
        sequence = pa.compute.coalesce(ds.field("record_sequence"), pa.scalar(""))
        wanted = (at > low) | ((at == low) & (sequence > pa.scalar(after)))
        wanted &= (at <= high) if to is None else (at < high) | ((at == high) & (sequence <= pa.scalar(to)))
        rows = self.data(partition.token).scanner(columns=["commit_timestamp", "record_sequence", "payload"], filter=wanted)
        for batch in rows.to_batches():
            if batch.num_rows:
                order = pa.compute.sort_indices(batch, [("commit_timestamp", "ascending"), ("record_sequence", "ascending")])
                batch = batch.take(order)
                stamps = batch.column(0).cast(kind).cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([pa.array([partition.token] * batch.num_rows), stamps, batch.column(1), batch.column(2)], names=["partition_token", "commit_timestamp", "record_sequence", "payload"])


class StreamReader(_Reader, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        self.at: dict[str, list] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """Each known partition's next watermark; those that are least far first, if not all may advance."""
        moves = {}
        for token in self.tokens():
            now, span = self._from(self.at, token), self.span(token)
            if span is None or span[0] > self.end:
                continue
            begin = now[0] if token in self.at else max(self.start, span[0])
            last = min(span[1], self.end, begin + self.step if self.step else self.end)
            if last >= now[0] and (move := [last, self.sequence(token, last)]) > now:
                moves[token] = move
        chosen = sorted(moves, key=lambda t: (self._from(self.at, t), t))[: self.most or None]
        self.at = self.at | {t: moves[t] for t in chosen}
        return self.at

    def _from(self, offset: dict, token: str) -> list:
        return offset.get(token, [self.start - 1, ""])

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self.at = {t: max(self._from(end, t), self._from(self.at, t)) for t in end | self.at}
        return [Slice(t, self._from(start, t), end[t]) for t in sorted(end) if end[t] > self._from(start, t)]

    def commit(self, end: dict) -> None:
        pass


class BatchReader(_Reader, DataSourceReader):
    def partitions(self) -> list[Slice]:
        return [Slice(t, (self.start - 1, ""), (self.end, None)) for t in self.tokens()]


class ChangesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "changes"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BatchReader:
        return BatchReader(dict(self.options))

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(ChangesSource)
