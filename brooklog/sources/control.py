"""Control tables derived from tables, and readers for those that are kept as Parquet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.functions.times import literal
from brooklog.schemas import ASSIGNMENTS, CREATED, END_OF_TIME, FINISHED, PARTITIONS, ROOT_TOKEN, RUNNERS, RUNNING, SCHEDULED


def partitions_from_orders(orders: DataFrame) -> DataFrame:
    status, key, start = F.col("o_orderstatus"), F.col("o_orderkey"), F.col("o_orderdate")
    state = F.when(status == "F", FINISHED).when(status == "P", RUNNING).when(key % 2 == 0, CREATED).otherwise(SCHEDULED)
    df = orders.select(F.concat(F.lit("o"), key.cast("string")).alias("partition_token"), state.alias("state"), start.alias("start_timestamp"), (key % 30).alias("days"))
    mark = F.when(F.col("state") == CREATED, F.col("start_timestamp")).otherwise(F.col("start_timestamp") + F.make_dt_interval(F.col("days").cast("int")))
    stamp = lambda *states: F.when(F.col("state").isin(*states), F.col("start_timestamp"))
    return df.select(
        "partition_token", F.array(F.lit(ROOT_TOKEN)).alias("parent_tokens"), "start_timestamp", literal(END_OF_TIME).alias("end_timestamp"), F.lit(10_000).cast("bigint").alias("heartbeat_millis"),
        "state", mark.alias("watermark"), F.col("start_timestamp").alias("created_at"),
        stamp(SCHEDULED, RUNNING, FINISHED).alias("scheduled_at"), stamp(RUNNING, FINISHED).alias("running_at"), F.when(F.col("state") == FINISHED, mark).alias("finished_at"),
    )


def runners_from_lineitem(lineitem: DataFrame) -> DataFrame:
    runner = F.concat(F.lit("r"), F.col("l_suppkey").cast("string")).alias("runner_id")
    return lineitem.where("l_returnflag = 'R'").groupBy(runner).agg(F.min("l_shipdate").alias("created_at"), F.max("l_shipdate").alias("updated_at"))


def assignments_from_lineitem(lineitem: DataFrame) -> DataFrame:
    token, runner = F.concat(F.lit("o"), F.col("l_orderkey").cast("string")), F.concat(F.lit("r"), F.col("l_suppkey").cast("string"))
    return lineitem.where("l_linenumber = 1").groupBy(token.alias("partition_token"), runner.alias("runner_id")).agg(F.min("l_shipdate").alias("created_at"), F.max("l_shipdate").alias("updated_at"))


def last_seen(runners: DataFrame) -> datetime:
    """The newest stamp, as the time at which derived tables are looked at."""
    return runners.agg(F.max("updated_at")).first()[0] or datetime(1970, 1, 1)


def empty(spark: SparkSession) -> dict[str, DataFrame]:
    """The three tables without rows."""
    return {"partitions": spark.createDataFrame([], PARTITIONS), "runners": spark.createDataFrame([], RUNNERS), "assignments": spark.createDataFrame([], ASSIGNMENTS)}


class ControlStore:
    """Control tables as Parquet folders: a new version is written beside the old one, then named current. One driver writes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self, name: str) -> list[int]:
        at = self._path(f"{self.root}/{name}")
        if not self._fs.exists(at):
            return []
        return sorted(int(s.getPath().getName()[1:]) for s in self._fs.listStatus(at) if self._fs.exists(self._path(s.getPath(), "_SUCCESS")))

    def migrate(self) -> None:
        """Makes the tables that are not there yet."""
        for name, rows in empty(self.spark).items():
            if not self._versions(name):
                self.write(name, rows)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/v{self._versions(name)[-1]}")

    def write(self, name: str, rows: DataFrame, keep: int = 2) -> None:
        """A version counts once Spark has marked it complete; older ones than the last keep are removed."""
        versions = self._versions(name)
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}/v{(versions or [0])[-1] + 1}")
        for old in versions[: -(keep - 1) or None]:
            self._fs.delete(self._path(f"{self.root}/{name}/v{old}"), True)
