"""Connected components of a graph of long ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklog.llm.common import remove, written


def components(edges: DataFrame, scratch: str) -> DataFrame:
    """For each node of an edge (u, v): node, component (its smallest reachable id). Each round is written, so no lineage grows."""
    spark = edges.sparkSession

    def state(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    k = 0
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{scratch}/round0")
    before = state(now)
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()
        k += 1
        now, old = written(small, f"{scratch}/round{k}"), f"{scratch}/round{k - 1}"
        after = state(now)
        remove(spark, old)
        if after == before:
            roots = now.select(F.col("v").alias("u")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select(F.col("u").alias("node"), F.col("u").alias("component")))
        before = after
