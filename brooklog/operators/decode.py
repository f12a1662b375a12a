"""From nested wire records to emitted records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklog.functions.times import rfc3339

DATA = [
    "commit_timestamp", "record_sequence", "server_transaction_id", "is_last_record_in_transaction_in_partition", "table_name", "column_types", "mods", "mod_type",
    "value_capture_type", "number_of_records_in_transaction", "number_of_partitions_in_transaction", "transaction_tag", "is_system_transaction",
]
META = ["start_timestamp", "created_at", "scheduled_at", "running_at"]


def decoded_type(kind: Column) -> Column:
    """code, and array_element_type if the type has an object of that name."""
    return F.struct(F.variant_get(kind, "$.code", "string").alias("code"), F.try_variant_get(kind, "$.array_element_type.code", "string").alias("array_element_type"))


def decoded_column_types(types: Column) -> Column:
    return F.transform(types, lambda x: F.struct(x["name"].alias("name"), decoded_type(x["type"]).alias("type"), x["is_primary_key"].alias("is_primary_key"), x["ordinal_position"].alias("ordinal_position")))


def events(wire: DataFrame) -> DataFrame:
    """All events of each fetch in order: partition_token, row_id, rec_idx, kind_ord (0 data, 1 heartbeat, 2 child partitions), idx, event_timestamp, data, children."""
    rows = wire.select("partition_token", "row_id", F.posexplode("change_record").alias("rec_idx", "r"))

    def part(field: str, kind: int, at: str, keep: str | None = None) -> DataFrame:
        x = rows.select("partition_token", "row_id", "rec_idx", F.lit(kind).alias("kind_ord"), F.posexplode(f"r.{field}").alias("idx", "x"))
        found = x.withColumn("event_timestamp", F.col(f"x.{at}"))
        return found.withColumnRenamed("x", keep) if keep else found.drop("x")

    data = part("data_change_record", 0, "commit_timestamp", "data")
    beats = part("heartbeat_record", 1, "timestamp")
    children = part("child_partitions_record", 2, "start_timestamp", "children")
    return data.unionByName(beats, allowMissingColumns=True).unionByName(children, allowMissingColumns=True)


def running_watermark(found: DataFrame) -> DataFrame:
    """With watermark: the largest event time so far within the fetch."""
    order = W.partitionBy("partition_token", "row_id").orderBy("rec_idx", "kind_ord", "idx").rowsBetween(W.unboundedPreceding, W.currentRow)
    return found.withColumn("watermark", F.max("event_timestamp").over(order))


def flatten(wire: DataFrame, partitions: DataFrame) -> DataFrame:
    """Emitted records: the 13 columns of a data record and six of its partition; watermark is that of the fetch so far."""
    found = running_watermark(events(wire)).where("kind_ord = 0")
    found = found.select(*(decoded_column_types(F.col("data.column_types")).alias(c) if c == "column_types" else F.col(f"data.{c}").alias(c) for c in DATA), "partition_token", "watermark")
    return found.join(partitions.select("partition_token", *META), "partition_token").select(*DATA, "partition_token", "start_timestamp", "watermark", "created_at", "scheduled_at", "running_at")


def payload_json(emitted: DataFrame) -> Column:
    """The emitted record as JSON: null stamps, empty payloads, absent element types and a false is_primary_key are left out."""
    full = lambda v: F.when(F.to_json(v) != "{}", v)
    types = F.transform("column_types", lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"), F.nullif(x["is_primary_key"], F.lit(False)).alias("is_primary_key"), x["ordinal_position"].alias("ordinal_position")))
    mods = F.transform("mods", lambda m: F.struct(*(full(m[c]).alias(c) for c in ("keys", "new_values", "old_values"))))
    stamps = {"commit_timestamp", *META, "watermark"}
    return F.to_json(F.struct(*((types if c == "column_types" else mods if c == "mods" else rfc3339(F.col(c)) if c in stamps else F.col(c)).alias(c) for c in emitted.columns)))
