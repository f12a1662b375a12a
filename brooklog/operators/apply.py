"""Beyond the subscription itself: tables from changes, and redelivered records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_rows(log: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """The state that a log leaves: for each key the values of its last record, without deleted rows."""
    last = log.groupBy(*keys).agg(F.max_by(F.struct("mod_type", *values), F.struct(*order)).alias("last"))
    return last.where("last.mod_type <> 'DELETE'").select(*keys, *(F.col(f"last.{v}").alias(v) for v in values))


def without_redelivery(log: DataFrame) -> DataFrame:
    """One of the records that share transaction, sequence and partition."""
    return log.dropDuplicates(["server_transaction_id", "record_sequence", "partition_token"])
