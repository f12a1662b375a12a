from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brooklog.operators import control, lineage, transitions, watermarks
from brooklog.sources.control import ControlStore, empty

NOW = datetime(2024, 1, 1)


def partitions(spark, *rows):
    """token, state, hours from NOW."""
    out = empty(spark)["partitions"]
    for token, state, hours in rows:
        out = transitions.initialize_root(out, NOW + timedelta(hours=hours), NOW)
        out = out.withColumn("state", F.when(F.col("partition_token") == "Parent0", state).otherwise(F.col("state"))).replace("Parent0", token, "partition_token")
    return out


def workers(spark, **seconds_ago):
    rows = [(r, NOW - timedelta(seconds=s), NOW - timedelta(seconds=s)) for r, s in seconds_ago.items()]
    return spark.createDataFrame(rows, "runner_id string, created_at timestamp_ntz, updated_at timestamp_ntz")


def tokens(df):
    return sorted(r["partition_token"] for r in df.collect())


def test_least_unfinished(spark):
    assert watermarks.least_unfinished(partitions(spark)).count() == 0
    assert watermarks.least_unfinished(partitions(spark, ("a", "FINISHED", 0))).count() == 0
    assert tokens(watermarks.least_unfinished(partitions(spark, ("p1", "CREATED", 1), ("p2", "RUNNING", 0), ("p3", "FINISHED", -1)))) == ["p2"]


def test_root_can_be_initialised_again(spark):
    once = transitions.initialize_root(empty(spark)["partitions"], "1970-01-01", NOW, heartbeat_millis=10_000)
    row = transitions.initialize_root(once, NOW, NOW, heartbeat_millis=3_600_000).collect()
    assert [(r["state"], r["watermark"], r["heartbeat_millis"], r["scheduled_at"]) for r in row] == [("CREATED", NOW, 3_600_000, None)]


def test_claim(spark):
    three = partitions(spark, ("p1", "CREATED", 0), ("p2", "CREATED", 0), ("p3", "RUNNING", 0))
    claimed = control.claimable(three, NOW, "s")
    assert tokens(claimed) == ["p1", "p2"]
    after = transitions.schedule(three, claimed, NOW)
    assert {r["partition_token"]: r["state"] for r in after.collect()} == {"p1": "SCHEDULED", "p2": "SCHEDULED", "p3": "RUNNING"}
    many = partitions(spark, *((f"p{k}", "CREATED", 0) for k in range(10)))
    first = control.claimable(many, NOW, "s", limit=5)
    second = control.claimable(transitions.schedule(many, first, NOW), NOW, "t", limit=100)
    assert len(tokens(first)) == 5 and not set(tokens(first)) & set(tokens(second)) and len(tokens(second)) == 5


def test_children_wait_for_parents_if_asked(spark):
    base = partitions(spark, ("p", "RUNNING", 0), ("q", "CREATED", 0)).withColumn("parent_tokens", F.when(F.col("partition_token") == "q", F.array(F.lit("p"))).otherwise(F.col("parent_tokens")))
    assert tokens(control.claimable(base, NOW, "s")) == ["q"]
    assert tokens(control.claimable(base, NOW, "s", parents_first=True)) == []


def test_interrupted(spark):
    four = partitions(spark, ("stale", "RUNNING", 0), ("orphan", "SCHEDULED", 0), ("live", "RUNNING", 0), ("created", "CREATED", 0), ("unknown", "RUNNING", 0))
    runners = workers(spark, dead=10, alive=1)
    held = empty(spark)["assignments"]
    for token, runner in (("stale", "dead"), ("live", "dead"), ("live", "alive"), ("unknown", "nobody")):
        held = transitions.assign(held, spark.createDataFrame([(token,)], "partition_token string"), runner, NOW)
    found = control.interrupted(four, runners, held, NOW)
    assert {r["partition_token"]: r["reason"] for r in found.collect()} == {"stale": "stale", "orphan": "orphan"}
    taken = transitions.assign(held, found, "alive", NOW)
    assert control.interrupted(four, runners, taken, NOW).count() == 0
    assert taken.where("partition_token = 'stale'").count() == 2  # the old row stays


def test_thresholds_are_inclusive_and_strict(spark):
    runners = workers(spark, a=3, b=5, c=4.999999, d=2)
    assert control.active_runners(runners, NOW).first()[0] == 3
    held = spark.createDataFrame([(r, r, NOW, NOW) for r in "abcd"], "partition_token string, runner_id string, created_at timestamp_ntz, updated_at timestamp_ntz")
    assert tokens(control.stale(runners, held, NOW)) == ["a", "b", "c"]


def test_refresh_keeps_the_day_of_registration(spark):
    later = NOW + timedelta(seconds=9)
    row = transitions.refresh_runner(transitions.register_runner(workers(spark, x=0), "r", NOW), "r", later).where("runner_id = 'r'").first()
    assert (row["created_at"], row["updated_at"]) == (NOW, later)


@pytest.mark.parametrize("children, want", [([("p1", "c1", ["p1"]), ("p1", "c2", ["p1"])], {"c1": ["p1"], "c2": ["p1"]}), ([("p1", "m", ["p1", "p2"]), ("p2", "m", ["p1", "p2"])], {"m": ["p1", "p2"]}), ([("p1", t, ["p1"]) for t in "abc"], {t: ["p1"] for t in "abc"})])
def test_children_are_inserted_once(spark, children, want):
    base = partitions(spark, ("p1", "RUNNING", 0), ("p2", "RUNNING", 0))
    rows = spark.createDataFrame([(r, NOW + timedelta(days=1), "1", t, p) for r, t, p in children], "reader string, start_timestamp timestamp_ntz, record_sequence string, token string, parent_tokens array<string>")
    after = transitions.add_children(transitions.add_children(base, rows, NOW), rows, NOW)
    got = {r["partition_token"]: r for r in after.collect() if r["partition_token"] in want}
    assert {t: r["parent_tokens"] for t, r in got.items()} == want and after.count() == 2 + len(want)
    assert all(r["state"] == "CREATED" and r["watermark"] == NOW + timedelta(days=1) and r["heartbeat_millis"] == 3000 for r in got.values())


def test_lineage(spark):
    rows = spark.createDataFrame([("a", "b", ["a"]), ("a", "c", ["a"]), ("b", "d", ["b", "c"]), ("c", "d", ["b", "c"])], "reader string, token string, parent_tokens array<string>")
    assert {r["child"]: (r["n_parents"], r["n_siblings"]) for r in lineage.degrees(rows).collect()} == {"b": (1, 2), "c": (1, 2), "d": (2, 1)}
    assert {(r["child"], r["ancestor"]): r["distance"] for r in lineage.ancestors(rows).where("child = 'd'").collect()} == {("d", "b"): 1, ("d", "c"): 1, ("d", "a"): 2}


def test_watermarks_never_go_back(spark):
    base = partitions(spark, ("p", "RUNNING", 5), ("q", "RUNNING", 5))
    marks = spark.createDataFrame([("p", NOW), ("q", NOW + timedelta(hours=9))], "partition_token string, new_watermark timestamp_ntz")
    after = {r["partition_token"]: r["watermark"] for r in transitions.set_watermarks(base, marks).collect()}
    assert after == {"p": NOW + timedelta(hours=5), "q": NOW + timedelta(hours=9)}


def test_finish_at_end(spark):
    base = partitions(spark, ("p", "RUNNING", 5), ("q", "RUNNING", 5)).withColumn("end_timestamp", F.when(F.col("partition_token") == "p", F.col("watermark")).otherwise(F.col("end_timestamp")))
    assert {r["partition_token"]: r["state"] for r in transitions.finish_at_end(base, NOW).collect()} == {"p": "FINISHED", "q": "RUNNING"}


@pytest.mark.parametrize("limit, active, free", [(0, 3, 100), (50, 0, 50), (50, 20, 30), (50, 50, 0), (50, 51, 0)])
def test_slots(limit, active, free):
    assert control.slots(limit, active) == free


def test_store_keeps_versions(spark, tmp_path):
    store = ControlStore(spark, str(tmp_path))
    store.migrate()
    store.migrate()
    assert store.read("runners").count() == 0
    for k in range(3):
        store.write("runners", transitions.register_runner(store.read("runners"), f"r{k}", NOW))
    assert store.read("runners").count() == 3
    assert len(store._versions("runners")) == 2


def test_ttl(spark):
    rows = spark.createDataFrame([("old", NOW - timedelta(days=2)), ("new", NOW), ("none", None)], "partition_token string, finished_at timestamp_ntz")
    assert tokens(control.expired(rows, "finished_at", NOW)) == ["old"]
    assert tokens(control.compacted(rows, "finished_at", NOW)) == ["new", "none"]
