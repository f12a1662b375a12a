"""Questions to the control tables. The time is always an argument."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.functions.times import earlier, literal
from brooklog.schemas import CREATED, RUNNING, SCHEDULED

STALE, ACTIVE, TTL = "3 SECONDS", "5 SECONDS", "1 DAY"
#: Partitions claimed at a time where their number is not limited.
DEFAULT_BATCH = 100


def active_runners(runners: DataFrame, now: datetime, active: str = ACTIVE) -> DataFrame:
    """One row: active_runners, those seen later than now less active."""
    return runners.where(F.col("updated_at") > earlier(literal(now), active)).agg(F.count(F.lit(1)).alias("active_runners"))


def owners(runners: DataFrame, assignments: DataFrame) -> DataFrame:
    """A row for each assigned partition: n_assignments and last_seen, of the newest runner that is known (null if none is)."""
    return assignments.join(runners.select("runner_id", F.col("updated_at").alias("seen")), "runner_id", "left").groupBy("partition_token").agg(F.count(F.lit(1)).alias("n_assignments"), F.max("seen").alias("last_seen"))


def stale(runners: DataFrame, assignments: DataFrame, now: datetime, after: str = STALE) -> DataFrame:
    """Assigned partitions whose newest runner was last seen at now less after, or earlier."""
    return owners(runners, assignments).where(F.col("last_seen") <= earlier(literal(now), after)).select("partition_token", "last_seen")


def in_progress(partitions: DataFrame) -> DataFrame:
    return partitions.where(F.col("state").isin(SCHEDULED, RUNNING))


def orphans(partitions: DataFrame, assignments: DataFrame) -> DataFrame:
    """Partitions in progress that nobody is assigned to."""
    return in_progress(partitions).join(assignments, "partition_token", "left_anti")


def interrupted(partitions: DataFrame, runners: DataFrame, assignments: DataFrame, now: datetime, after: str = STALE, limit: int | None = None) -> DataFrame:
    """Partitions in progress that are orphans or stale, with reason; with a limit those of least watermark. A partition assigned only to runners that are not known is neither."""
    owned = owners(runners, assignments)
    joined = in_progress(partitions).join(owned, "partition_token", "left")
    reason = F.when(F.col("n_assignments").isNull(), "orphan").when(F.col("last_seen") <= earlier(literal(now), after), "stale")
    found = joined.withColumn("reason", reason).where("reason IS NOT NULL").select(*partitions.columns, "reason")
    return found if limit is None else found.orderBy("watermark", "partition_token").limit(limit)


def claimable(partitions: DataFrame, min_watermark: datetime, seed: str, limit: int = DEFAULT_BATCH, parents_first: bool = False) -> DataFrame:
    """Created partitions from min_watermark on, in an order that seed shuffles; parents_first: only those all of whose known parents have finished."""
    found = partitions.where((F.col("state") == CREATED) & (F.col("start_timestamp") >= literal(min_watermark)))
    if parents_first:
        waiting = found.select("partition_token", F.explode("parent_tokens").alias("parent")).join(partitions.where("state <> 'FINISHED'").select(F.col("partition_token").alias("parent")), "parent", "left_semi")
        found = found.join(waiting.select("partition_token").distinct(), "partition_token", "left_anti")
    return found.orderBy(F.md5(F.concat(F.lit(seed), "partition_token").cast("binary")), "start_timestamp", "partition_token").limit(limit)


def slots(limit: int, active: int) -> int:
    """How many partitions may be claimed: a limit of 0 means none."""
    return DEFAULT_BATCH if limit == 0 else max(0, limit - active)


def capacity_percent(active: Column, limit: Column) -> Column:
    """-1 without a limit; may exceed 100."""
    return F.when(limit == 0, F.lit(-1.0)).otherwise(active / limit * 100.0)


def capacity(partitions: DataFrame, assignments: DataFrame, limit: int) -> DataFrame:
    """For each runner: active_partitions, max_partitions, available_slots, capacity_percent."""
    held = assignments.join(partitions.where(F.col("state") == RUNNING).select("partition_token"), "partition_token", "left_semi")
    df = held.groupBy("runner_id").agg(F.count_distinct("partition_token").alias("active_partitions")).withColumn("max_partitions", F.lit(limit).cast("bigint"))
    free = F.when(F.col("max_partitions") == 0, F.lit(DEFAULT_BATCH)).otherwise(F.greatest(F.col("max_partitions") - F.col("active_partitions"), F.lit(0))).cast("bigint")
    return df.select("*", free.alias("available_slots"), capacity_percent(F.col("active_partitions"), F.col("max_partitions")).alias("capacity_percent"))


def expired(rows: DataFrame, column: str, now: datetime, ttl: str = TTL) -> DataFrame:
    """Rows whose stamp is older than now less ttl; rows without one stay."""
    return rows.where(F.col(column) < earlier(literal(now), ttl))


def compacted(rows: DataFrame, column: str, now: datetime, ttl: str = TTL) -> DataFrame:
    return rows.where(F.col(column).isNull() | (F.col(column) >= earlier(literal(now), ttl)))


def compacted_assignments(assignments: DataFrame, runners: DataFrame, now: datetime, ttl: str = TTL, active: str = ACTIVE) -> DataFrame:
    """Assignments of runners that are alive stay, however old."""
    alive = runners.where(F.col("updated_at") > earlier(literal(now), active)).select("runner_id", F.lit(True).alias("alive"))
    kept = assignments.join(alive, "runner_id", "left")
    return kept.where(F.col("alive") | (F.col("updated_at") >= earlier(literal(now), ttl))).select(*assignments.columns)
