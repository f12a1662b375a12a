from __future__ import annotations

import io
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brooklog import cli
from brooklog.sources import changes
from brooklog.streaming import cursor, metrics
from brooklog.streaming.subscriber import Gate, NackError, json_lines, subscribe

SCHEMA = "partition_token string, commit_timestamp timestamp_ntz, record_sequence string, payload string"


@pytest.fixture
def log(spark, tmp_path):
    """Two partitions of three records each, out of order in the files."""
    path = str(tmp_path / "log")
    add(spark, path, [(p, s, f"{p}{s}") for p in "ab" for s in (3, 1, 2)])
    return path


def add(spark, path, rows):
    df = spark.createDataFrame([(p, f"{s:08d}", x, s) for p, s, x in rows], "partition_token string, record_sequence string, payload string, s int")
    df = df.withColumn("commit_timestamp", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s")
    df.write.mode("append").option("parquet.int96", "false").partitionBy("partition_token").parquet(path)


@pytest.fixture(autouse=True, scope="module")
def micros(spark):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    changes.register(spark)


def stream(spark, path, **options):
    return spark.readStream.format("changes").options(path=path, **options).load()


def run(spark, path, checkpoint, **options):
    got = []
    known = {k: options.pop(k) for k in list(options) if k[0].islower() and k in ("startTimestamp", "endTimestamp", "maxPartitionsPerTrigger", "stepSeconds")}
    subscribe(stream(spark, path, **known), str(checkpoint), got.append, bounded=True, **options).awaitTermination()
    return got


def test_bounded_read_delivers_in_order_and_ends(spark, log, tmp_path):
    assert run(spark, log, tmp_path / "c") == ["a1", "a2", "a3", "b1", "b2", "b3"]


def test_restart_resumes_each_partition(spark, log, tmp_path):
    run(spark, log, tmp_path / "c")
    add(spark, log, [("a", 4, "a4"), ("c", 1, "c1")])  # c: a child that appears later
    assert run(spark, log, tmp_path / "c") == ["a4", "c1"]
    assert run(spark, log, tmp_path / "c") == []


def test_range_is_inclusive(spark, log, tmp_path):
    assert run(spark, log, tmp_path / "c", startTimestamp="1970-01-01T00:00:02Z", endTimestamp="1970-01-01T00:00:02Z") == ["a2", "b2"]
    assert spark.read.format("changes").options(path=log, startTimestamp="1970-01-01T00:00:02Z").load().count() == 4


def test_nack_brings_the_batch_again(spark, log, tmp_path):
    seen = []

    def refuse(document, ack):
        seen.append(document)
        ack(ValueError("no") if document == "b2" and len(seen) < 7 else None)

    with pytest.raises(Exception, match="not acknowledged"):
        subscribe(stream(spark, log), str(tmp_path / "c"), ack_consumer=refuse, bounded=True).awaitTermination()
    assert len(seen) == 6
    subscribe(stream(spark, log), str(tmp_path / "c"), ack_consumer=refuse, bounded=True).awaitTermination()
    assert seen[6:] == ["a1", "a2", "a3", "b1", "b2", "b3"]


def test_acknowledgements_from_other_threads(spark, log, tmp_path):
    with ThreadPoolExecutor(2) as pool:
        subscribe(stream(spark, log), str(tmp_path / "c"), ack_consumer=lambda d, ack: pool.submit(lambda: (time.sleep(0.05), ack())), bounded=True, ack_timeout=30).awaitTermination()


def test_gate():
    gate = Gate()
    with pytest.raises(TimeoutError, match="0 of 1"):
        gate.wait(1, 0.05)
    gate = Gate()
    ack = gate.once()
    ack()
    ack()  # counts once
    with pytest.raises(TimeoutError):
        gate.wait(2, 0.05)
    threading.Timer(0.05, gate.once()).start()
    gate.wait(2, 5)
    gate.wait(0)
    gate.acknowledge(ValueError("x"))
    with pytest.raises(NackError):
        gate.wait(9)


def test_consumer_error_ends_at_once(spark, log, tmp_path):
    def fail(document):
        raise ValueError("cannot take it")

    with pytest.raises(Exception, match="cannot take it"):
        subscribe(stream(spark, log), str(tmp_path / "c"), fail, bounded=True).awaitTermination()


def test_one_consumer_only(spark, log, tmp_path):
    for more in ({}, {"consumer": print, "ack_consumer": print}):
        with pytest.raises(ValueError, match="one of"):
            subscribe(stream(spark, log), str(tmp_path / "c"), **more)


def test_delivery_from_tasks(spark, log, tmp_path):
    out = tmp_path / "out"
    out.mkdir()

    def consume(document):
        (out / document).touch()

    subscribe(stream(spark, log), str(tmp_path / "c"), consume, serialized=False, bounded=True).awaitTermination()
    assert sorted(p.name for p in out.iterdir()) == ["a1", "a2", "a3", "b1", "b2", "b3"]


def test_limited_partitions(tmp_path, spark, log):
    reader = changes.StreamReader({"path": log, "maxPartitionsPerTrigger": "1"})
    first = dict(reader.latestOffset())
    second = dict(reader.latestOffset())
    assert list(first) == ["a"] and sorted(second) == ["a", "b"]
    assert [(s.token, s.low) for s in reader.partitions(first, second)] == [("b", (changes.micros("0001-01-01") - 1, ""))]


def put(root, name, rows, **options):
    """rows: (seconds, sequence) of partition a."""
    (root / "partition_token=a").mkdir(parents=True, exist_ok=True)
    table = pa.table({"commit_timestamp": pa.array([s * 1_000_000 for s, _ in rows], pa.timestamp("us")), "record_sequence": [q for _, q in rows], "payload": [f"{s}-{q}" for s, q in rows]})
    pq.write_table(table, root / "partition_token=a" / name, **options)


def delivered(reader, start, end):
    return [r for x in reader.partitions(start, end) for b in reader.read(x) for r in b.column(3).to_pylist()]


def test_a_later_record_of_the_same_commit_time_is_delivered(tmp_path):
    put(tmp_path, "1.parquet", [(1, "1"), (5, "1"), (5, "2")])
    reader = changes.StreamReader({"path": str(tmp_path)})
    first = dict(reader.latestOffset())
    assert delivered(reader, {}, first) == ["1-1", "5-1", "5-2"]
    put(tmp_path, "2.parquet", [(5, "3")])
    again = changes.StreamReader({"path": str(tmp_path)})  # a restart
    again.partitions({}, first)
    second = dict(again.latestOffset())
    assert delivered(again, first, second) == ["5-3"] and dict(again.latestOffset()) == second


def test_files_without_statistics_are_delivered(tmp_path):
    put(tmp_path, "1.parquet", [(3, "1"), (2, "1")], write_statistics=False)
    reader = changes.StreamReader({"path": str(tmp_path)})
    assert delivered(reader, {}, dict(reader.latestOffset())) == ["2-1", "3-1"]


def test_steps_begin_at_the_first_commit(tmp_path):
    put(tmp_path, "1.parquet", [(100, "1"), (104, "1"), (110, "1"), (125, "1")])
    reader, at, got = changes.StreamReader({"path": str(tmp_path), "stepSeconds": "10"}), {}, []
    while (offset := dict(reader.latestOffset())) != at:
        got.append(delivered(reader, at, offset))
        at = offset
    assert got == [["100-1", "104-1", "110-1"], [], ["125-1"]]


def test_json_lines():
    out = io.StringIO()
    json_lines(out)("{}")
    json_lines(out)("[]")
    assert out.getvalue() == "{}\n[]\n"


def test_cursor_state_never_goes_back(spark, tmp_path):
    path = str(tmp_path / "events")
    rows = lambda *xs: spark.createDataFrame([(p, t, d) for p, t, d in xs], "partition_token string, s int, is_data boolean").select("partition_token", F.timestamp_seconds("s").alias("event_timestamp"), "is_data")
    schema = "partition_token string, event_timestamp timestamp, is_data boolean"
    rows(("a", 5, True), ("b", 1, True)).write.mode("append").parquet(path)

    def go():
        got = {}

        def keep(df, number):
            got.update({r["partition_token"]: (r["w"], r["n_records"]) for r in df.select("partition_token", F.unix_timestamp("watermark").alias("w"), "n_records").collect()})

        found = cursor.cursors(spark.readStream.schema(schema).parquet(path))
        found.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
        return got

    assert go() == {"a": (5, 1), "b": (1, 1)}
    rows(("a", 3, True), ("b", 9, False)).write.mode("append").parquet(path)
    assert go() == {"a": (5, 2), "b": (9, 1)}


@pytest.mark.parametrize("limit, active, want", [(0, 3, (3, 0, 100, -1.0)), (100, 25, (25, 100, 75, 25.0)), (50, 50, (50, 50, 0, 100.0)), (50, 60, (60, 50, 0, 120.0))])
def test_metrics(limit, active, want):
    held = metrics.ActiveSet(limit)
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(held.add, map(str, range(active))))
    m = held.metrics()
    assert (m.active_partitions, m.max_partitions, m.available_slots, m.capacity_percent) == want
    held.remove("0")
    assert len(held) == active - 1


def test_cli(spark, log, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda *a, **k: spark)
    monkeypatch.setattr(cli.signal, "signal", lambda *a: None)
    assert cli.main(["--path", log, "--checkpoint", str(tmp_path / "c"), "--control", str(tmp_path / "control"), "--end", "1970-01-01T00:00:01Z", "--log-level", "nonsense"]) == 0
    assert capsys.readouterr().out.split() == ["a1", "b1"]
    with pytest.raises(SystemExit):
        cli.main(["--path", log])
