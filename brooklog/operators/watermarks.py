"""Watermarks of partitions and of a whole stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklog.schemas import FINISHED


def by_partition(found: DataFrame, at: str = "commit_timestamp") -> DataFrame:
    return found.groupBy("partition_token").agg(F.max(at).alias("watermark"))


def advanced(old: Column, new: Column) -> Column:
    """Never back, and unchanged by an empty fetch."""
    return F.greatest(old, new)


def low(partitions: DataFrame) -> DataFrame:
    """The least watermark of unfinished partitions, one row; null without any."""
    return partitions.where(F.col("state") != FINISHED).agg(F.min("watermark").alias("low_watermark"))


def least_unfinished(partitions: DataFrame) -> DataFrame:
    """The unfinished partition of least watermark, on ties of least token."""
    return partitions.where(F.col("state") != FINISHED).orderBy("watermark", "partition_token").limit(1)


def advance(partitions: DataFrame, found: DataFrame, at: str = "commit_timestamp") -> DataFrame:
    """partitions with the watermarks that the events found bring."""
    new = by_partition(found, at).withColumnRenamed("watermark", "new_watermark")
    return partitions.join(new, "partition_token", "left").withColumn("watermark", advanced(F.col("watermark"), F.col("new_watermark"))).select(*partitions.columns)
