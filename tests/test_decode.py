from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from brooklog.functions import types as type_codes
from brooklog.functions.times import rfc3339
from brooklog.operators import decode
from brooklog.schemas import WIRE_RECORD

DATA = "struct<commit_timestamp: string, record_sequence: string, server_transaction_id: string, is_last_record_in_transaction_in_partition: boolean, table_name: string, column_types: array<struct<name: string, type: string, is_primary_key: boolean, ordinal_position: bigint>>, mods: array<struct<keys: string, new_values: string, old_values: string>>, mod_type: string, value_capture_type: string, number_of_records_in_transaction: bigint, number_of_partitions_in_transaction: bigint, transaction_tag: string, is_system_transaction: boolean>"
META = ("token-1", "2023-01-01 10:00:00", "2023-01-01 11:00:00", "2023-01-01 09:00:00", "2023-01-01 09:30:00", None)


def record(table, types, mods, kind):
    return ("2023-01-01 12:00:00", "seq-1", "txn-1", True, table, types, mods, kind, "OLD_AND_NEW_VALUES", 1, 1, "tag-1", False)


CASES = [
    record("users", [("id", '{"code":"INT64"}', True, 1), ("name", '{"code":"STRING"}', False, 2)], [('{"id":"9007199254740993"}', '{"id":"9007199254740993","name":"John"}', None)], "INSERT"),
    record("products", [("tags", '{"code":"ARRAY","array_element_type":{"code":"STRING"}}', False, 1)], [('{"id":"1"}', '{"tags":["a","b"]}', '{"tags":["a"]}')], "UPDATE"),
    record("deleted_items", [], [('{"id":"1"}', None, None)], "DELETE"),
]


@pytest.fixture(scope="module")
def emitted(spark):
    rows = spark.createDataFrame([("token-1", "2023-01-01 12:00:00", [r], [], []) for r in CASES], f"partition_token string, row_id string, data array<{DATA}>, beats array<string>, kids array<string>")
    fixed = F.transform(
        "data",
        lambda d: F.struct(
            *(
                F.to_timestamp_ntz(d[c]).alias(c) if c == "commit_timestamp"
                else F.transform(d[c], lambda x: F.struct(x["name"].alias("name"), F.parse_json(x["type"]).alias("type"), x["is_primary_key"].alias("is_primary_key"), x["ordinal_position"].alias("ordinal_position"))).alias(c) if c == "column_types"
                else F.transform(d[c], lambda m: F.struct(*(F.parse_json(m[k]).alias(k) for k in ("keys", "new_values", "old_values")))).alias(c) if c == "mods"
                else d[c].alias(c)
                for c in decode.DATA
            )
        ),
    )
    wire = rows.select("partition_token", F.col("data")[0]["table_name"].alias("row_id"), F.array(F.struct(
        fixed.alias("data_change_record"), F.array().cast("array<struct<timestamp: timestamp_ntz>>").alias("heartbeat_record"),
        F.array().cast("array<struct<start_timestamp: timestamp_ntz, record_sequence: string, child_partitions: array<struct<token: string, parent_partition_tokens: array<string>>>>>").alias("child_partitions_record"),
    )).cast(WIRE_RECORD).alias("change_record"))
    names = ["partition_token", "start_timestamp", "watermark", "created_at", "scheduled_at", "running_at"]
    meta = spark.createDataFrame([META], ", ".join(f"{n} string" for n in names)).select("partition_token", *(F.to_timestamp_ntz(n).alias(n) for n in names[1:]))
    return decode.flatten(wire, meta).cache()


def payload(emitted, table):
    return json.loads(emitted.where(F.col("table_name") == table).select(decode.payload_json(emitted)).first()[0])


def test_insert(emitted):
    found = payload(emitted, "users")
    assert found["mods"] == [{"keys": {"id": "9007199254740993"}, "new_values": {"id": "9007199254740993", "name": "John"}}]
    assert found["column_types"] == [{"name": "id", "type": {"code": "INT64"}, "is_primary_key": True, "ordinal_position": 1}, {"name": "name", "type": {"code": "STRING"}, "ordinal_position": 2}]
    assert found["commit_timestamp"] == found["watermark"] == "2023-01-01T12:00:00Z"
    assert "running_at" not in found and found["scheduled_at"] == "2023-01-01T09:30:00Z"
    assert list(found)[:3] == ["commit_timestamp", "record_sequence", "server_transaction_id"]


def test_update_with_array(emitted):
    found = payload(emitted, "products")
    assert found["column_types"][0]["type"] == {"code": "ARRAY", "array_element_type": "STRING"}
    assert found["mods"][0]["old_values"] == {"tags": ["a"]}
    row = emitted.where("table_name = 'products'").select(type_codes.typed(F.col("mods")[0]["new_values"], "tags", "ARRAY", "STRING")).first()[0]
    assert row == ["a", "b"]


def test_delete_has_no_values(emitted):
    assert payload(emitted, "deleted_items")["mods"] == [{"keys": {"id": "1"}}]
    assert payload(emitted, "deleted_items")["column_types"] == []


def test_whole_numbers_are_read_exactly(emitted):
    got = emitted.where("table_name = 'users'").select(type_codes.typed(F.col("mods")[0]["keys"], "id", "INT64")).first()[0]
    assert got == 2**53 + 1


@pytest.mark.parametrize("text, want", [("2023-01-01 12:00:10", "2023-01-01T12:00:10Z"), ("2023-01-01 12:00:00.1234", "2023-01-01T12:00:00.1234Z"), ("2023-01-01 12:00:00.5", "2023-01-01T12:00:00.5Z")])
def test_rfc3339(spark, text, want):
    assert spark.range(1).select(rfc3339(F.lit(text).cast("timestamp_ntz"))).first()[0] == want


def test_running_watermark_against_a_loop(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 2), st.integers(0, 50)), min_size=1, max_size=30, unique_by=lambda x: x[:3]))
    def check(rows):
        df = spark.createDataFrame([("p", "r", *x) for x in rows], "partition_token string, row_id string, rec_idx int, kind_ord int, idx int, event_timestamp int")
        got = {(r["rec_idx"], r["kind_ord"], r["idx"]): r["watermark"] for r in decode.running_watermark(df).collect()}
        most = 0
        for x in sorted(rows):
            most = max(most, x[3])
            assert got[x[:3]] == most

    check()
