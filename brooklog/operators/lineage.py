"""The graph of partitions that split and merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def edges(children: DataFrame) -> DataFrame:
    """parent, child: once each, however often a record was delivered."""
    return children.select(F.explode("parent_tokens").alias("parent"), F.col("token").alias("child")).distinct()


def degrees(children: DataFrame) -> DataFrame:
    """For each child: n_parents (over 1: a merge) and n_siblings, the children of its parents (over 1: a split)."""
    found = edges(children)
    siblings = found.groupBy("parent").agg(F.count(F.lit(1)).alias("n_children"))
    return found.join(siblings, "parent").groupBy("child").agg(F.count(F.lit(1)).alias("n_parents"), F.max("n_children").alias("n_siblings"), F.min("parent").alias("first_parent"))


def ancestors(children: DataFrame, depth: int = 16) -> DataFrame:
    """child, ancestor, distance (the least), up to depth generations."""
    found = edges(children)
    level = found.select("child", F.col("parent").alias("ancestor"), F.lit(1).alias("distance"))
    out = level
    for k in range(2, depth + 1):
        level = level.join(found.withColumnsRenamed({"child": "ancestor", "parent": "older"}), "ancestor").select("child", F.col("older").alias("ancestor"), F.lit(k).alias("distance")).distinct()
        if level.isEmpty():
            break
        out = out.unionByName(level)
    return out.groupBy("child", "ancestor").agg(F.min("distance").alias("distance"))
