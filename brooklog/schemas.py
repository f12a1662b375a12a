"""Schemas of wire records, emitted records and control tables."""

from __future__ import annotations

from pyspark.sql import types as T

WIRE_RECORD = """array<struct<
  data_change_record: array<struct<
    commit_timestamp: timestamp_ntz, record_sequence: string, server_transaction_id: string,
    is_last_record_in_transaction_in_partition: boolean, table_name: string,
    column_types: array<struct<name: string, type: variant, is_primary_key: boolean, ordinal_position: bigint>>,
    mods: array<struct<keys: variant, new_values: variant, old_values: variant>>,
    mod_type: string, value_capture_type: string,
    number_of_records_in_transaction: bigint, number_of_partitions_in_transaction: bigint,
    transaction_tag: string, is_system_transaction: boolean>>,
  heartbeat_record: array<struct<timestamp: timestamp_ntz>>,
  child_partitions_record: array<struct<start_timestamp: timestamp_ntz, record_sequence: string,
    child_partitions: array<struct<token: string, parent_partition_tokens: array<string>>>>>>>""".replace("\n", " ")

#: Columns of a partition that emitted records carry.
PARTITION_META = ["partition_token", "start_timestamp", "watermark", "created_at", "scheduled_at", "running_at"]

PARTITIONS = """partition_token string, parent_tokens array<string>, start_timestamp timestamp_ntz, end_timestamp timestamp_ntz,
  heartbeat_millis bigint, state string, watermark timestamp_ntz, created_at timestamp_ntz,
  scheduled_at timestamp_ntz, running_at timestamp_ntz, finished_at timestamp_ntz""".replace("\n", " ")
RUNNERS = "runner_id string, created_at timestamp_ntz, updated_at timestamp_ntz"
ASSIGNMENTS = "partition_token string, runner_id string, created_at timestamp_ntz, updated_at timestamp_ntz"

ROOT_TOKEN = "Parent0"
CREATED, SCHEDULED, RUNNING, FINISHED = "CREATED", "SCHEDULED", "RUNNING", "FINISHED"
#: The last timestamp in microseconds; sources whose clock is finer are cut to it.
END_OF_TIME = "9999-12-31T23:59:59.999999"


def parsed(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
