"""Change logs derived from tables, flat and in the nested form in which a stream delivers them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brooklog.functions.times import hour_of
from brooklog.schemas import WIRE_RECORD

#: name, code, is_primary_key, ordinal_position of the columns of the events table.
EVENT_COLUMNS = [("user_id", "INT64", True, 1), ("event_type", "STRING", False, 2), ("value", "FLOAT64", False, 3), ("k", "INT64", False, 4)]


def from_events(events: DataFrame) -> DataFrame:
    """A data record for each event: the user's row is inserted by signup, deleted by error, updated by others."""
    by_user = W.partitionBy("user_id").orderBy("event_id")
    kind = F.when(F.col("event_type") == "signup", "INSERT").when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE")
    df = events.select(
        "event_id", "user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.col("ts").alias("commit_timestamp"), F.lpad(F.col("event_id").cast("string"), 8, "0").alias("record_sequence"),
        F.concat(F.lit("txn-"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyy-MM-dd")).alias("server_transaction_id"),
        F.lit("events").alias("table_name"), kind.alias("mod_type"), F.concat(F.lit("p"), (F.col("user_id") % 8).cast("string")).alias("partition_token"), hour_of(F.col("ts")).alias("row_id"),
    )
    old = [F.when(F.col("mod_type") != "INSERT", F.lag(c).over(by_user)).alias(f"old_{c}") for c in ("event_type", "value", "k")]
    txn = W.partitionBy("user_id", "server_transaction_id")
    return df.select("*", *old, F.count(F.lit(1)).over(txn).alias("number_of_records_in_transaction"), (F.row_number().over(txn.orderBy(F.desc("event_id"))) == 1).alias("is_last_record_in_transaction_in_partition"))


def _json(*columns: Column) -> Column:
    return F.parse_json(F.to_json(F.struct(*columns)))


def _type(code: str) -> Column:
    return F.parse_json(F.lit(f'{{"code":"{code}"}}'))


def data_record() -> Column:
    types = F.array(*(F.struct(F.lit(n).alias("name"), _type(c).alias("type"), F.lit(pk).alias("is_primary_key"), F.lit(k).cast("bigint").alias("ordinal_position")) for n, c, pk, k in EVENT_COLUMNS))
    new = F.when(F.col("mod_type") != "DELETE", _json("event_type", "value", "k"))
    old = F.when(F.col("old_event_type").isNotNull(), _json(*(F.col(f"old_{c}").alias(c) for c in ("event_type", "value", "k"))))
    mod = F.struct(_json("user_id").alias("keys"), new.alias("new_values"), old.alias("old_values"))
    return F.struct(
        "commit_timestamp", "record_sequence", "server_transaction_id", "is_last_record_in_transaction_in_partition", "table_name", types.alias("column_types"), F.array(mod).alias("mods"), "mod_type",
        F.lit("OLD_AND_NEW_VALUES").alias("value_capture_type"), "number_of_records_in_transaction", F.lit(1).cast("bigint").alias("number_of_partitions_in_transaction"),
        F.lit("").alias("transaction_tag"), F.lit(False).alias("is_system_transaction"),
    )


def to_wire(log: DataFrame) -> DataFrame:
    """partition_token, row_id, change_record: a row for each fetch, with a record for each change in order of commit."""
    one = F.struct(F.col("commit_timestamp").alias("at"), F.col("record_sequence").alias("seq"), data_record().alias("data"))
    # variants have no order, so positions are sorted and the records follow
    rows = log.select("partition_token", "row_id", one.alias("x")).groupBy("partition_token", "row_id").agg(F.collect_list("x").alias("xs"))
    ordered = F.transform(F.array_sort("xs", lambda a, b: F.when((a["at"] < b["at"]) | ((a["at"] == b["at"]) & (a["seq"] < b["seq"])), -1).when((a["at"] == b["at"]) & (a["seq"] == b["seq"]), 0).otherwise(1)), lambda x: x["data"])
    empty = "heartbeat_record: array<struct<timestamp: timestamp_ntz>>, child_partitions_record: array<struct<start_timestamp: timestamp_ntz, record_sequence: string, child_partitions: array<struct<token: string, parent_partition_tokens: array<string>>>>>".split(", child_partitions_record: ")
    record = F.transform(ordered, lambda d: F.struct(F.array(d).alias("data_change_record"), F.array().cast(empty[0].split(": ", 1)[1]).alias("heartbeat_record"), F.array().cast(empty[1]).alias("child_partitions_record")))
    return rows.select("partition_token", "row_id", record.cast(WIRE_RECORD).alias("change_record"))


def heartbeats(log: DataFrame) -> DataFrame:
    """One at the end of each hour in which a partition had a fetch: partition_token, row_id, event_timestamp."""
    return log.select("partition_token", "row_id").distinct().withColumn("event_timestamp", F.col("row_id") + F.expr("INTERVAL 1 HOUR"))


def transactions(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """A data record for each line of an order that is in orders; an order is a transaction, numbered over all columns."""
    order = [c for c in lineitem.columns if c != "l_orderkey"]
    lines = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    txn = W.partitionBy("l_orderkey")
    return lines.select(
        F.concat(F.lit("order-"), F.col("l_orderkey").cast("string")).alias("server_transaction_id"), F.col("l_orderkey").alias("o_orderkey"), F.col("o_orderdate").alias("commit_timestamp"),
        F.row_number().over(txn.orderBy(*order)).alias("record_number"), F.count(F.lit(1)).over(txn).alias("number_of_records_in_transaction"),
    ).withColumn("is_last_record_in_transaction_in_partition", F.col("record_number") == F.col("number_of_records_in_transaction"))


def child_records(spark: SparkSession) -> DataFrame:
    """p0 to p3 split in two, p4 and p5 merge (told by both): reader, start_timestamp, record_sequence, token, parent_tokens."""
    at = "2024-01-15 00:00:00"
    rows = [(f"p{k}", at, f"{k:08d}", f"p{k}{half}", [f"p{k}"]) for k in range(4) for half in "ab"]
    rows += [(reader, at, "00000004", "p45", ["p4", "p5"]) for reader in ("p4", "p5")]
    return spark.createDataFrame(rows, "reader string, at string, record_sequence string, token string, parent_tokens array<string>").select("reader", F.col("at").cast("timestamp_ntz").alias("start_timestamp"), "record_sequence", "token", "parent_tokens")
