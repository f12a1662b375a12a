"""Type codes that records describe their columns with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Code, and the type that holds its values.
CODES = {
    "BOOL": "boolean",
    "INT64": "bigint",
    "FLOAT64": "double",
    "TIMESTAMP": "timestamp",
    "DATE": "date",
    "STRING": "string",
    "BYTES": "binary",
    "NUMERIC": "decimal(38,9)",
    "JSON": "variant",
    "ARRAY": "array",
}


def table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(CODES.items()), "code string, spark_type string")


def spark_type(code: Column, element: Column | None = None) -> Column:
    """The type's name; null for a code that is not listed."""
    known = F.create_map(*(F.lit(x) for pair in CODES.items() for x in pair))
    inner = F.concat(F.lit("array<"), known[element], F.lit(">")) if element is not None else F.lit(None).cast("string")
    return F.when(code == "ARRAY", inner).otherwise(F.try_element_at(known, code))


def typed(payload: Column, name: str, code: str, element: str | None = None) -> Column:
    """A column of a variant payload with the type of its code; null if it isn't there or doesn't fit."""
    path = f"$.{name}"
    if code == "BYTES":
        return F.try_to_binary(F.try_variant_get(payload, path, "string"), F.lit("base64"))
    if code == "JSON":
        return F.try_variant_get(payload, path, "variant")
    if code == "ARRAY":
        return F.try_variant_get(payload, path, f"array<{CODES[element or 'STRING']}>")
    return F.try_variant_get(payload, path, CODES[code])
