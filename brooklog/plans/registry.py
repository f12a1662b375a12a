"""Queries on change logs and control tables, by name, each with the SQL that gives the same rows."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.functions import types as type_codes
from brooklog.functions.times import literal
from brooklog.operators import apply, control, decode, lineage, transitions, watermarks
from brooklog.schemas import END_OF_TIME, ROOT_TOKEN, RUNNING
from brooklog.sources import changelog
from brooklog.sources.control import assignments_from_lineitem, last_seen, partitions_from_orders, runners_from_lineitem
from brooklog.streaming.subscriber import subscribe

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
#: In the derived control tables time runs in days.
STALE, ACTIVE, TTL = "3 DAYS", "5 DAYS", "1 DAY"
NOW = "2024-02-01T00:00:00"
RANGE = ("2024-01-05T00:00:00", "2024-01-20T00:00:00")
SPLIT = "2024-01-15T00:00:00"

CL = """cl AS (
  SELECT event_id, user_id, event_type, value, CAST(props->>'k' AS BIGINT) AS k, ts AS commit_timestamp, lpad(CAST(event_id AS VARCHAR), 8, '0') AS record_sequence,
    'txn-' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS server_transaction_id, 'events' AS table_name,
    CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS mod_type,
    'p' || CAST(user_id % 8 AS VARCHAR) AS partition_token, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS row_id
  FROM events),
tx AS (SELECT *, count(*) OVER (PARTITION BY user_id, server_transaction_id) AS n_records, row_number() OVER (PARTITION BY user_id, server_transaction_id ORDER BY event_id DESC) = 1 AS is_last FROM cl),
parts AS (SELECT partition_token, min(commit_timestamp) AS start_timestamp FROM cl GROUP BY partition_token)"""
CT = """p AS (
  SELECT 'o' || CAST(o_orderkey AS VARCHAR) AS partition_token, o_orderdate AS start_timestamp,
    CASE WHEN o_orderstatus = 'F' THEN 'FINISHED' WHEN o_orderstatus = 'P' THEN 'RUNNING' WHEN o_orderkey % 2 = 0 THEN 'CREATED' ELSE 'SCHEDULED' END AS state, o_orderkey FROM orders),
parts AS (SELECT partition_token, start_timestamp, state, CASE WHEN state = 'CREATED' THEN start_timestamp ELSE start_timestamp + to_days(CAST(o_orderkey % 30 AS INTEGER)) END AS watermark FROM p),
runners AS (SELECT 'r' || CAST(l_suppkey AS VARCHAR) AS runner_id, min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey),
assigned AS (SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS partition_token, 'r' || CAST(l_suppkey AS VARCHAR) AS runner_id, min(l_shipdate) AS created_at, max(l_shipdate) AS updated_at FROM lineitem WHERE l_linenumber = 1 GROUP BY l_orderkey, l_suppkey),
clock AS (SELECT max(updated_at) AS now FROM runners),
stale AS (SELECT a.partition_token, max(r.updated_at) AS last_seen FROM runners r JOIN assigned a ON r.runner_id = a.runner_id GROUP BY a.partition_token HAVING max(r.updated_at) <= (SELECT now FROM clock) - INTERVAL 3 DAY)"""


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.from_events(_read(spark, sf_dir, "events"))


def _log_partitions(log: DataFrame) -> DataFrame:
    """The partitions of the derived log: their stamps follow from its first record."""
    first = log.groupBy("partition_token").agg(F.min("commit_timestamp").alias("start_timestamp"))
    stamps = [F.col("start_timestamp").alias(c) for c in ("created_at", "scheduled_at", "running_at")]
    return first.select("partition_token", "start_timestamp", F.col("start_timestamp").alias("watermark"), *stamps)


def _partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions_from_orders(_read(spark, sf_dir, "orders"))


def _workers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lineitem = _read(spark, sf_dir, "lineitem")
    return runners_from_lineitem(lineitem), assignments_from_lineitem(lineitem)


PLAIN = "partition_token, state, start_timestamp, watermark"
SLIM = PLAIN.split(", ")


@query(f"""WITH {CL} SELECT commit_timestamp, record_sequence, server_transaction_id, is_last AS is_last_record_in_transaction_in_partition, table_name, mod_type, 'OLD_AND_NEW_VALUES' AS value_capture_type,
  n_records AS number_of_records_in_transaction, CAST(1 AS BIGINT) AS number_of_partitions_in_transaction, '' AS transaction_tag, false AS is_system_transaction, partition_token, start_timestamp,
  max(commit_timestamp) OVER (PARTITION BY partition_token, row_id ORDER BY commit_timestamp, record_sequence ROWS UNBOUNDED PRECEDING) AS watermark, start_timestamp AS created_at
  FROM tx JOIN parts USING (partition_token)""")
def change_flatten(spark, sf_dir):
    log = _log(spark, sf_dir)
    return decode.flatten(changelog.to_wire(log), _log_partitions(log)).drop("column_types", "mods", "scheduled_at", "running_at")


@query(f"WITH {CL} SELECT mod_type, count(*) AS n_records, count(DISTINCT partition_token) AS n_partitions, min(commit_timestamp) AS first_commit, max(commit_timestamp) AS last_commit FROM cl GROUP BY mod_type")
def change_by_mod_type(spark, sf_dir):
    return _log(spark, sf_dir).groupBy("mod_type").agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("partition_token").alias("n_partitions"), F.min("commit_timestamp").alias("first_commit"), F.max("commit_timestamp").alias("last_commit"))


@query(f"""WITH {CL}, c(name, code, is_primary_key, ordinal_position) AS (VALUES ('user_id', 'INT64', true, 1), ('event_type', 'STRING', false, 2), ('value', 'FLOAT64', false, 3), ('k', 'INT64', false, 4))
  SELECT name, code, CAST(NULL AS VARCHAR) AS array_element_type, is_primary_key, CAST(ordinal_position AS BIGINT) AS ordinal_position, count(*) AS n_records FROM cl, c GROUP BY name, code, is_primary_key, ordinal_position""")
def column_types_decode(spark, sf_dir):
    found = decode.events(changelog.to_wire(_log(spark, sf_dir))).where("kind_ord = 0")
    x = found.select(F.explode(decode.decoded_column_types(F.col("data.column_types"))).alias("x"))
    return x.groupBy(F.col("x.name").alias("name"), F.col("x.type.code").alias("code"), F.col("x.type.array_element_type").alias("array_element_type"), F.col("x.is_primary_key").alias("is_primary_key"), F.col("x.ordinal_position").alias("ordinal_position")).agg(F.count(F.lit(1)).alias("n_records"))


@query(f"""WITH {CL}, o AS (SELECT *, lag(event_type) OVER w AS e, lag(value) OVER w AS v, lag(k) OVER w AS j FROM cl WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
  SELECT record_sequence, mod_type, user_id, CASE WHEN mod_type <> 'DELETE' THEN event_type END AS new_event_type, CASE WHEN mod_type <> 'DELETE' THEN value END AS new_value, CASE WHEN mod_type <> 'DELETE' THEN k END AS new_k,
    CASE WHEN mod_type <> 'INSERT' THEN e END AS old_event_type, CASE WHEN mod_type <> 'INSERT' THEN v END AS old_value, CASE WHEN mod_type <> 'INSERT' THEN j END AS old_k FROM o""")
def mods_explode(spark, sf_dir):
    found = decode.events(changelog.to_wire(_log(spark, sf_dir))).where("kind_ord = 0")
    mods = found.select("data.record_sequence", "data.mod_type", F.explode("data.mods").alias("m"))
    value = lambda side, prefix: [type_codes.typed(F.col(f"m.{side}"), c, code).alias(f"{prefix}_{c}") for c, code in (("event_type", "STRING"), ("value", "FLOAT64"), ("k", "INT64"))]
    return mods.select("record_sequence", "mod_type", type_codes.typed(F.col("m.keys"), "user_id", "INT64").alias("user_id"), *value("new_values", "new"), *value("old_values", "old"))


@query("""SELECT * FROM (VALUES ('BOOL', 'boolean'), ('INT64', 'bigint'), ('FLOAT64', 'double'), ('TIMESTAMP', 'timestamp'), ('DATE', 'date'), ('STRING', 'string'), ('BYTES', 'binary'), ('NUMERIC', 'decimal(38,9)'),
  ('JSON', 'variant'), ('ARRAY', 'array<string>'), ('GEOMETRY', NULL)) AS t(code, spark_type)""")
def type_code_lookup(spark, sf_dir):
    codes = type_codes.table(spark).select("code").unionByName(spark.range(1).select(F.lit("GEOMETRY").alias("code")))
    return codes.select("code", type_codes.spark_type(F.col("code"), F.lit("STRING")).alias("spark_type"))


@query(f"""WITH {CL}, b AS (SELECT DISTINCT partition_token, row_id, row_id + INTERVAL 1 HOUR AS ev FROM cl),
  e AS (SELECT partition_token, row_id, 0 AS kind_ord, record_sequence AS seq, commit_timestamp AS ev FROM cl UNION ALL SELECT partition_token, row_id, 1, '', ev FROM b)
  SELECT partition_token, row_id, kind_ord, seq, max(ev) OVER (PARTITION BY partition_token, row_id ORDER BY kind_ord, ev, seq ROWS UNBOUNDED PRECEDING) AS watermark FROM e""")
def running_watermark(spark, sf_dir):
    log = _log(spark, sf_dir)
    data = log.select("partition_token", "row_id", F.lit(0).alias("kind_ord"), F.col("record_sequence").alias("seq"), F.col("commit_timestamp").alias("event_timestamp"))
    beats = changelog.heartbeats(log).select("partition_token", "row_id", F.lit(1).alias("kind_ord"), F.lit("").alias("seq"), "event_timestamp")
    found = data.unionByName(beats).select("*", F.lit(0).alias("rec_idx"), F.struct("event_timestamp", "seq").alias("idx"))
    return decode.running_watermark(found).select("partition_token", "row_id", "kind_ord", "seq", "watermark")


@query(f"WITH {CL} SELECT partition_token, max(commit_timestamp) AS watermark FROM cl GROUP BY partition_token")
def partition_watermark(spark, sf_dir):
    token = F.concat(F.lit("p"), (F.col("user_id") % 8).cast("string"))
    return watermarks.by_partition(_read(spark, sf_dir, "events").select(token.alias("partition_token"), F.col("ts").alias("commit_timestamp")))


@query(f"WITH {CT} SELECT min(watermark) AS low_watermark FROM parts WHERE state <> 'FINISHED'")
def low_watermark(spark, sf_dir):
    return watermarks.low(_partitions(spark, sf_dir))


@query(f"WITH {CL} SELECT partition_token, row_id, count(*) AS expected_acks FROM cl GROUP BY partition_token, row_id")
def fetch_row_ack_count(spark, sf_dir):
    wire = changelog.to_wire(_log(spark, sf_dir))
    return wire.select("partition_token", "row_id", F.aggregate("change_record", F.lit(0).cast("bigint"), lambda acc, r: acc + F.size(r["data_change_record"])).alias("expected_acks"))


@query("""SELECT o_orderkey, count(*) AS n_seen, count(*) AS n_declared, 1 AS n_last, true AS complete FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def txn_completeness(spark, sf_dir):
    records = changelog.transactions(_read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem"))
    done = records.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n_seen"), F.max("number_of_records_in_transaction").alias("n_declared"), F.count_if("is_last_record_in_transaction_in_partition").cast("int").alias("n_last"))
    return done.withColumn("complete", (F.col("n_seen") == F.col("n_declared")) & (F.col("n_last") == 1))


@query(f"WITH {CL} SELECT partition_token, max(commit_timestamp) AS data_watermark, max(row_id) + INTERVAL 1 HOUR AS watermark FROM cl GROUP BY partition_token")
def heartbeat_advance(spark, sf_dir):
    log = _log(spark, sf_dir)
    return log.groupBy("partition_token").agg(F.max("commit_timestamp").alias("data_watermark"), F.max("row_id").alias("last")).select("partition_token", "data_watermark", watermarks.advanced(F.col("data_watermark"), F.col("last") + F.expr("INTERVAL 1 HOUR")).alias("watermark"))


CHILDREN = """ch(reader, token, parents) AS (VALUES ('p0', 'p0a', ['p0']), ('p0', 'p0b', ['p0']), ('p1', 'p1a', ['p1']), ('p1', 'p1b', ['p1']), ('p2', 'p2a', ['p2']), ('p2', 'p2b', ['p2']),
  ('p3', 'p3a', ['p3']), ('p3', 'p3b', ['p3']), ('p4', 'p45', ['p4', 'p5']), ('p5', 'p45', ['p4', 'p5']))"""


def _known(log: DataFrame) -> DataFrame:
    first = _log_partitions(log)
    none = F.lit(None).cast("timestamp_ntz")
    return first.select("partition_token", F.array(F.lit(ROOT_TOKEN)).alias("parent_tokens"), "start_timestamp", literal(END_OF_TIME).alias("end_timestamp"), F.lit(3000).cast("bigint").alias("heartbeat_millis"), F.lit(RUNNING).alias("state"), "watermark", "created_at", "scheduled_at", "running_at", none.alias("finished_at"))


@query(f"""WITH {CL}, {CHILDREN} SELECT partition_token, 'Parent0' AS parents, start_timestamp, start_timestamp AS watermark, 'RUNNING' AS state, CAST(3000 AS BIGINT) AS heartbeat_millis FROM parts
  UNION ALL SELECT token, array_to_string(parents, ','), TIMESTAMP '2024-01-15', TIMESTAMP '2024-01-15', 'CREATED', CAST(3000 AS BIGINT) FROM (SELECT DISTINCT token, parents FROM ch WHERE reader IN (SELECT partition_token FROM parts))""")
def child_partitions_insert(spark, sf_dir):
    known = _known(_log(spark, sf_dir))
    both = transitions.add_children(transitions.add_children(known, changelog.child_records(spark), NOW), changelog.child_records(spark), NOW)  # delivered twice
    return both.select("partition_token", F.array_join("parent_tokens", ",").alias("parents"), "start_timestamp", "watermark", "state", "heartbeat_millis")


@query(f"""WITH {CHILDREN}, e AS (SELECT DISTINCT token AS child, unnest(parents) AS parent FROM ch), s AS (SELECT parent, count(*) AS n FROM e GROUP BY parent)
  SELECT child, count(*) AS n_parents, max(n) AS n_siblings, min(parent) AS first_parent FROM e JOIN s USING (parent) GROUP BY child""")
def partition_lineage(spark, sf_dir):
    return lineage.degrees(changelog.child_records(spark))


@query(f"""WITH {CHILDREN}, e AS (SELECT DISTINCT token AS child, unnest(parents) AS parent FROM ch) SELECT child, parent AS ancestor, 1 AS distance FROM e
  UNION ALL SELECT 'leaf', child, 1 FROM (SELECT DISTINCT child FROM e) UNION ALL SELECT DISTINCT 'leaf', parent, 2 FROM e""")
def partition_ancestors(spark, sf_dir):
    """Every child's ancestors, and those of one partition that all children merge into."""
    children = changelog.child_records(spark)
    leaf = children.groupBy().agg(F.collect_set("token").alias("parent_tokens")).select(F.lit("p0a").alias("reader"), literal(SPLIT).alias("start_timestamp"), F.lit("9").alias("record_sequence"), F.lit("leaf").alias("token"), "parent_tokens")
    return lineage.ancestors(children.unionByName(leaf))


@query(f"WITH {CT} SELECT {PLAIN} FROM parts WHERE state <> 'FINISHED' ORDER BY watermark, partition_token LIMIT 1")
def unfinished_min_partition(spark, sf_dir):
    return watermarks.least_unfinished(_partitions(spark, sf_dir)).select(*SLIM)


@query(f"WITH {CT} SELECT {PLAIN} FROM parts WHERE state = 'CREATED' AND start_timestamp >= (SELECT min(watermark) FROM parts WHERE state <> 'FINISHED') ORDER BY md5('seed' || partition_token), start_timestamp, partition_token LIMIT 100")
def claim_topk(spark, sf_dir):
    partitions = _partitions(spark, sf_dir)
    least = watermarks.low(partitions).first()[0] or SPLIT
    return control.claimable(partitions, least, "seed").select(*SLIM)


@query(f"WITH {CT} SELECT count(*) AS active_runners FROM runners WHERE updated_at > (SELECT now FROM clock) - INTERVAL 5 DAY")
def active_runner_count(spark, sf_dir):
    runners, _ = _workers(spark, sf_dir)
    return control.active_runners(runners, last_seen(runners), ACTIVE)


@query(f"WITH {CT} SELECT partition_token, last_seen FROM stale")
def stale_partitions(spark, sf_dir):
    runners, assignments = _workers(spark, sf_dir)
    return control.stale(runners, assignments, last_seen(runners), STALE)


@query(f"WITH {CT} SELECT {PLAIN} FROM parts WHERE state IN ('SCHEDULED', 'RUNNING') AND partition_token NOT IN (SELECT partition_token FROM assigned)")
def orphan_partitions(spark, sf_dir):
    _, assignments = _workers(spark, sf_dir)
    return control.orphans(_partitions(spark, sf_dir), assignments).select(*SLIM)


INTERRUPTED = f"""WITH {CT}, found AS (SELECT DISTINCT m.partition_token, m.state, m.start_timestamp, m.watermark, CASE WHEN a.partition_token IS NULL THEN 'orphan' ELSE 'stale' END AS reason
  FROM parts m LEFT JOIN assigned a ON m.partition_token = a.partition_token WHERE m.state IN ('SCHEDULED', 'RUNNING') AND (a.partition_token IS NULL OR m.partition_token IN (SELECT partition_token FROM stale))) SELECT * FROM found"""


@query(INTERRUPTED)
def interrupted_partitions(spark, sf_dir):
    runners, assignments = _workers(spark, sf_dir)
    return control.interrupted(_partitions(spark, sf_dir), runners, assignments, last_seen(runners), STALE).select(*SLIM, "reason")


@query(f"{INTERRUPTED} ORDER BY watermark, partition_token LIMIT 100")
def interrupted_partitions_first(spark, sf_dir):
    runners, assignments = _workers(spark, sf_dir)
    return control.interrupted(_partitions(spark, sf_dir), runners, assignments, last_seen(runners), STALE, limit=100).select(*SLIM, "reason")


CLAIMED = "claimed AS (SELECT partition_token FROM parts WHERE state = 'CREATED' ORDER BY md5('seed' || partition_token), start_timestamp, partition_token LIMIT 100)"


@query(f"""WITH {CT}, {CLAIMED} SELECT partition_token, CASE WHEN partition_token IN (SELECT partition_token FROM claimed) THEN 'SCHEDULED' ELSE state END AS state,
  CASE WHEN partition_token IN (SELECT partition_token FROM claimed) THEN TIMESTAMP '2024-02-01' WHEN state = 'CREATED' THEN NULL ELSE start_timestamp END AS scheduled_at FROM parts""")
def claim_transition(spark, sf_dir):
    partitions = _partitions(spark, sf_dir)
    claimed = control.claimable(partitions, watermarks.low(partitions).first()[0] or SPLIT, "seed")
    return transitions.schedule(partitions, claimed, NOW).select("partition_token", "state", "scheduled_at")


@query(f"""WITH {CT}, {CLAIMED} SELECT partition_token, runner_id, updated_at FROM assigned WHERE NOT (partition_token IN (SELECT partition_token FROM claimed) AND runner_id = 'r1')
  UNION ALL SELECT partition_token, 'r1', TIMESTAMP '2024-02-01' FROM claimed""")
def claim_assignments(spark, sf_dir):
    partitions, (_, assignments) = _partitions(spark, sf_dir), _workers(spark, sf_dir)
    claimed = control.claimable(partitions, watermarks.low(partitions).first()[0] or SPLIT, "seed")
    return transitions.assign(assignments, claimed, "r1", NOW).select("partition_token", "runner_id", "updated_at")


@query(f"WITH {CT} SELECT partition_token, state, watermark FROM parts UNION ALL SELECT 'Parent0', 'CREATED', TIMESTAMP '2024-01-05'")
def root_reinit(spark, sf_dir):
    once = transitions.initialize_root(_partitions(spark, sf_dir), RANGE[1], NOW)
    return transitions.initialize_root(once, RANGE[0], NOW).select("partition_token", "state", "watermark")


@query(f"WITH {CT} SELECT runner_id, created_at, CASE WHEN runner_id = 'r1' THEN TIMESTAMP '2024-02-01' ELSE updated_at END AS updated_at FROM runners UNION ALL SELECT 'r-new', TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01'")
def runner_register_refresh(spark, sf_dir):
    runners, _ = _workers(spark, sf_dir)
    return transitions.refresh_runner(transitions.register_runner(runners, "r-new", NOW), "r1", NOW)


@query(f"""WITH {CT} SELECT partition_token, CASE state WHEN 'SCHEDULED' THEN 'RUNNING' WHEN 'RUNNING' THEN 'FINISHED' ELSE state END AS state,
  CASE state WHEN 'SCHEDULED' THEN TIMESTAMP '2024-02-01' WHEN 'CREATED' THEN NULL ELSE start_timestamp END AS running_at, CASE state WHEN 'RUNNING' THEN TIMESTAMP '2024-02-01' WHEN 'FINISHED' THEN watermark END AS finished_at FROM parts""")
def state_updates(spark, sf_dir):
    partitions = _partitions(spark, sf_dir)
    running, scheduled = (partitions.where(F.col("state") == s).select("partition_token") for s in ("RUNNING", "SCHEDULED"))
    return transitions.start(transitions.finish(partitions, running, NOW), scheduled, NOW).select("partition_token", "state", "running_at", "finished_at")


@query(f"""WITH {CT}, w AS (SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS partition_token, max(l_shipdate) AS m FROM lineitem GROUP BY l_orderkey)
  SELECT partition_token, greatest(watermark, coalesce(m, watermark)) AS watermark FROM parts LEFT JOIN w USING (partition_token)""")
def watermark_updates(spark, sf_dir):
    token = F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("partition_token")
    marks = _read(spark, sf_dir, "lineitem").groupBy(token).agg(F.max("l_shipdate").alias("new_watermark"))
    return transitions.set_watermarks(_partitions(spark, sf_dir), marks).select("partition_token", "watermark")


@query(f"WITH {CT} SELECT partition_token, watermark AS finished_at FROM parts WHERE state = 'FINISHED' AND watermark < (SELECT now FROM clock) - INTERVAL 1 DAY")
def ttl_expired(spark, sf_dir):
    runners, _ = _workers(spark, sf_dir)
    return control.expired(_partitions(spark, sf_dir), "finished_at", last_seen(runners), TTL).select("partition_token", "finished_at")


@query(f"""WITH {CT} SELECT a.partition_token, a.runner_id FROM assigned a LEFT JOIN runners r ON a.runner_id = r.runner_id AND r.updated_at > (SELECT now FROM clock) - INTERVAL 5 DAY
  WHERE r.runner_id IS NOT NULL OR a.updated_at >= (SELECT now FROM clock) - INTERVAL 1 DAY""")
def ttl_assignments(spark, sf_dir):
    runners, assignments = _workers(spark, sf_dir)
    return control.compacted_assignments(assignments, runners, last_seen(runners), TTL, ACTIVE).select("partition_token", "runner_id")


@query(f"""WITH {CT}, n AS (SELECT runner_id, count(DISTINCT partition_token) AS active_partitions FROM assigned WHERE partition_token IN (SELECT partition_token FROM parts WHERE state = 'RUNNING') GROUP BY runner_id)
  SELECT runner_id, active_partitions, CAST(100 AS BIGINT) AS max_partitions, greatest(100 - active_partitions, 0) AS available_slots, active_partitions / 100.0::DOUBLE * 100 AS capacity_percent FROM n""")
def capacity_metrics(spark, sf_dir):
    _, assignments = _workers(spark, sf_dir)
    return control.capacity(_partitions(spark, sf_dir), assignments, 100)


@query("SELECT event_id, ts AS commit_timestamp, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-20'")
def bounded_range_scan(spark, sf_dir):
    events = _read(spark, sf_dir, "events")
    return events.where(F.col("ts").between(*map(literal, RANGE))).select("event_id", F.col("ts").alias("commit_timestamp"), "user_id")


@query(f"WITH {CL}, m AS (SELECT partition_token, max(commit_timestamp) AS watermark FROM cl WHERE commit_timestamp <= TIMESTAMP '2024-01-15' GROUP BY partition_token) SELECT partition_token, record_sequence, commit_timestamp FROM cl LEFT JOIN m USING (partition_token) WHERE watermark IS NULL OR commit_timestamp >= watermark")
def resume_scan(spark, sf_dir):
    """At least once: each partition again from its stored watermark on."""
    token = F.concat(F.lit("p"), (F.col("user_id") % 8).cast("string")).alias("partition_token")
    log = _read(spark, sf_dir, "events").select(token, F.lpad(F.col("event_id").cast("string"), 8, "0").alias("record_sequence"), F.col("ts").alias("commit_timestamp"))
    stored = watermarks.by_partition(log.where(F.col("commit_timestamp") <= literal(SPLIT)))
    return log.join(stored, "partition_token", "left").where("watermark IS NULL OR commit_timestamp >= watermark").select("partition_token", "record_sequence", "commit_timestamp")


@query(f"WITH {CL} SELECT partition_token, record_sequence, server_transaction_id, commit_timestamp FROM cl")
def dedup_redelivery(spark, sf_dir):
    """A tenth of the records comes twice."""
    log = _log(spark, sf_dir).select("partition_token", "record_sequence", "server_transaction_id", "commit_timestamp")
    again = log.where(F.conv(F.left(F.md5(F.col("record_sequence").cast("binary")), F.lit(4)), 16, 10).cast("int") % 10 == 0)
    return apply.without_redelivery(log.unionByName(again))


@query(f"WITH {CL}, l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY commit_timestamp DESC, record_sequence DESC) AS n FROM cl) SELECT user_id, event_type, value, k FROM l WHERE n = 1 AND mod_type <> 'DELETE'")
def latest_row_state(spark, sf_dir):
    return apply.latest_rows(_log(spark, sf_dir), ["user_id"], ["event_type", "value", "k"], ["commit_timestamp", "record_sequence"])


@query()
def payload_json(spark, sf_dir):
    log = _log(spark, sf_dir)
    emitted = decode.flatten(changelog.to_wire(log), _log_partitions(log))
    return emitted.select("record_sequence", decode.payload_json(emitted).alias("payload"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey FROM nation")
def stream_ack_gate(spark, sf_dir):
    """The nations, delivered as a stream of JSON documents whose batch waits for all acknowledgements: the keys that were acknowledged."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp()
    path = f"{sf_dir}/nation.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path[:-1]}[{path[-1]}]")
    got: list[int] = []

    def take(document, ack):
        got.append(json.loads(document)["n_nationkey"])
        ack(None)

    subscribe(stream.select(F.to_json(F.struct("n_nationkey", "n_name")).alias("payload")), f"{base}/brooklog/ack-{uuid.uuid4().hex}", ack_consumer=take, bounded=True, ack_timeout=60).awaitTermination()
    return spark.createDataFrame([(k,) for k in got], "n_nationkey long")
