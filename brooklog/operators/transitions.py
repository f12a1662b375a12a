"""Changes of the control tables: each gives the table that follows. Nothing is updated in place."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.functions.times import literal
from brooklog.schemas import CREATED, END_OF_TIME, FINISHED, PARTITIONS, ROOT_TOKEN, RUNNING, SCHEDULED
from brooklog.operators.watermarks import advanced


def upsert(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(rows.select(*keys), keys, "left_anti").unionByName(rows.select(*table.columns))


def insert_missing(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is there already, or came before, change nothing."""
    return table.unionByName(rows.dropDuplicates(keys).join(table.select(*keys), keys, "left_anti").select(*table.columns))


def register_runner(runners: DataFrame, runner_id: str, now: datetime) -> DataFrame:
    row = runners.sparkSession.range(1).select(F.lit(runner_id).alias("runner_id"), literal(now).alias("created_at"), literal(now).alias("updated_at"))
    return upsert(runners, row, ["runner_id"])


def refresh_runner(runners: DataFrame, runner_id: str, now: datetime) -> DataFrame:
    return runners.withColumn("updated_at", F.when(F.col("runner_id") == runner_id, literal(now)).otherwise(F.col("updated_at")))


def initialize_root(partitions: DataFrame, start: datetime | str, now: datetime, end: datetime | str = END_OF_TIME, heartbeat_millis: int = 3000) -> DataFrame:
    """The root as created, its stamps cleared, whether or not it was there."""
    none = F.lit(None).cast("timestamp_ntz")
    row = partitions.sparkSession.range(1).select(
        F.lit(ROOT_TOKEN).alias("partition_token"), F.array().cast("array<string>").alias("parent_tokens"), literal(start).alias("start_timestamp"), literal(end).alias("end_timestamp"),
        F.lit(heartbeat_millis).cast("bigint").alias("heartbeat_millis"), F.lit(CREATED).alias("state"), literal(start).alias("watermark"), literal(now).alias("created_at"),
        none.alias("scheduled_at"), none.alias("running_at"), none.alias("finished_at"),
    )
    return upsert(partitions, row, ["partition_token"])


def _where_claimed(partitions: DataFrame, tokens: DataFrame, changes: dict[str, Column]) -> DataFrame:
    marked = partitions.join(tokens.select("partition_token", F.lit(True).alias("chosen")), "partition_token", "left")
    return marked.select(*(F.when(F.col("chosen"), changes[c]).otherwise(F.col(c)).alias(c) if c in changes else c for c in partitions.columns))


def schedule(partitions: DataFrame, claimed: DataFrame, now: datetime) -> DataFrame:
    return _where_claimed(partitions, claimed, {"state": F.lit(SCHEDULED), "scheduled_at": literal(now)})


def assign(assignments: DataFrame, tokens: DataFrame, runner_id: str, now: datetime) -> DataFrame:
    """tokens go to runner_id; rows of other runners stay."""
    rows = tokens.select("partition_token", F.lit(runner_id).alias("runner_id"), literal(now).alias("created_at"), literal(now).alias("updated_at"))
    return upsert(assignments, rows, ["partition_token", "runner_id"])


def start(partitions: DataFrame, tokens: DataFrame, now: datetime) -> DataFrame:
    return _where_claimed(partitions, tokens, {"state": F.lit(RUNNING), "running_at": literal(now)})


def finish(partitions: DataFrame, tokens: DataFrame, now: datetime) -> DataFrame:
    return _where_claimed(partitions, tokens, {"state": F.lit(FINISHED), "finished_at": literal(now)})


def finish_at_end(partitions: DataFrame, now: datetime) -> DataFrame:
    """Running partitions whose watermark has reached their end finish."""
    done = (F.col("state") == RUNNING) & (F.col("watermark") >= F.col("end_timestamp"))
    return partitions.withColumns({"finished_at": F.when(done, literal(now)).otherwise(F.col("finished_at")), "state": F.when(done, FINISHED).otherwise(F.col("state"))})


def set_watermarks(partitions: DataFrame, marks: DataFrame) -> DataFrame:
    """marks: partition_token, new_watermark."""
    joined = partitions.join(marks.select("partition_token", "new_watermark"), "partition_token", "left")
    return joined.withColumn("watermark", advanced(F.col("watermark"), F.col("new_watermark"))).select(*partitions.columns)


def add_children(partitions: DataFrame, children: DataFrame, now: datetime) -> DataFrame:
    """children: reader, start_timestamp, token, parent_tokens. They inherit end and heartbeat from the partition that told of them; those that are there already stay as they are."""
    parents = partitions.select(F.col("partition_token").alias("reader"), "end_timestamp", "heartbeat_millis")
    none = F.lit(None).cast("timestamp_ntz")
    rows = children.join(parents, "reader").select(
        F.col("token").alias("partition_token"), "parent_tokens", "start_timestamp", "end_timestamp", "heartbeat_millis", F.lit(CREATED).alias("state"),
        F.col("start_timestamp").alias("watermark"), literal(now).alias("created_at"), none.alias("scheduled_at"), none.alias("running_at"), none.alias("finished_at"),
    )
    return insert_missing(partitions, rows, ["partition_token"])


def empty_partitions(spark) -> DataFrame:
    return spark.createDataFrame([], PARTITIONS)
