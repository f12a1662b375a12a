"""Shared folders, heavy keys and small column helpers."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
#: An id that is null counts as the largest id.
LAST_ID = 2**63 - 1
#: Keys with more than a 1/HOT_PARTS share of the rows are dealt over several tasks, so there are fewer than HOT_PARTS of them.
HOT_PARTS = 1000
#: Rows and bytes of an Arrow batch at most (a single longer row is a batch of its own), so what a Python worker holds of its input is bounded.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, which driver and executors share. Where that is unset (tests in one JVM), a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="brooklog-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/brooklog/{name}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's limits on Arrow batches to BATCH_ROWS and BATCH_BYTES."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if not now or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


_owner: list = [None, None]


def own_caches(name: str, forget: Callable[[], None]) -> None:
    """Called by a task before it uses the caches of its worker process: what operators of another name keep there is forgotten, so a worker that serves many stages holds one's caches only."""
    if _owner[0] not in (None, name):
        _owner[1]()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)
    _owner[:] = [name, forget]


def unused(name: str, df: DataFrame) -> str:
    """name, with underscores before it until no column of df has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name


def make_folder(spark: SparkSession, folder: str) -> str:
    """Makes the folder; its URI, for tasks that open files there with pyarrow.fs."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    store = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(at)
    return store.makeQualified(at).toString()


def attempt() -> str:
    """For names of files: another one for each task attempt, so only those count that a successful attempt returns."""
    task = TaskContext.get()
    return f"{task.stageId()}-{task.partitionId()}-{task.taskAttemptId()}"


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of DataFrames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """The rows as a table in a shared folder: lineage ends here, so a lost executor costs no recomputation before this point."""
    df.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    release(df.sparkSession)
    return out


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column], F.lit(""))


def id_of(df: DataFrame, column: str = "doc_id") -> Column:
    return F.coalesce(df[column].cast("long"), F.lit(LAST_ID))


def back_id(column: Column | str) -> Column:
    """Undoes id_of."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != LAST_ID, c)


def hot_cells(counted: DataFrame, key: str, n: str, total: int, parts: int = HOT_PARTS) -> DataFrame:
    """(key, cells) for keys with more than total / parts rows: fewer than parts rows, whatever the data, so it may be broadcast."""
    limit = max(1, total // parts)
    return counted.where(F.col(n) > limit).select(key, F.ceil(F.col(n) / F.lit(float(limit))).cast("int").alias("cells"))


def salted_join(rows: DataFrame, table: DataFrame, key: str | list[str], hot: DataFrame, spread: Column, how: str = "inner") -> DataFrame:
    """rows joined with table (one row a key) on key. Rows of a hot key are dealt over its cells by spread, and table's row of it is repeated once a cell: fewer than 2 * HOT_PARTS rows more in all."""
    hot = F.broadcast(hot)
    cell = F.when(F.col("cells").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.col("cells")).cast("int"))
    left = rows.join(hot, key, "left").withColumn("cell", cell).drop("cells")
    right = table.join(hot, key, "left").withColumn("cell", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("cells"), F.lit(1)) - 1))).drop("cells")
    return left.join(right, [*([key] if isinstance(key, str) else key), "cell"], how).drop("cell")
