"""Exact deduplication by a keyed state that never expires.

A streaming aggregation keeps one state row a digest in RocksDB, checkpointed in a shared folder: the number of rows seen, and of the
row that stays its stable id and its content locator (file and row in the file). Later runs with the same folder continue that state.
Only DataFrame and streaming operations are used.

The key is the SHA-256 of the normalised text. On every hit (a digest held by several rows) the bytes of each row are compared with
those of the row that the locator names; rows that differ (a digest collision) are grouped anew by their normalised text itself.

Defined results: a null text counts as empty, and empty texts are equal to each other; a null doc_id counts as larger than any id and
comes back as null; of rows that repeat both text and doc_id one stays (the first by file and row); an empty table gives no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import LAST_ID, WHITE, back_id, hot_cells, salted_join, shared_dir, written

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition holds 4 MB from the start
}


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


class ExactDedup:
    """digest: of a normalised text; tests pass a weak one to see collisions resolved."""

    def __init__(self, spark: SparkSession, state: str, id_column: str = "doc_id", text_column: str = "text", digest: Callable[[Column], Column] = sha256):
        self.spark, self.state, self.id_column, self.text_column, self.digest = spark, state.rstrip("/"), id_column, text_column, digest

    def _keyed(self, docs: DataFrame, text: bool = False) -> DataFrame:
        norm = normalised(docs[self.text_column])
        place = F.struct(docs["_metadata.file_path"].alias("file"), docs["_metadata.row_index"].alias("row"))
        return docs.select(
            self.digest(norm).alias("digest"),
            F.coalesce(docs[self.id_column].cast("long"), F.lit(LAST_ID)).alias("id"),
            F.coalesce(F.length(docs[self.text_column]), F.lit(0)).alias("points"),
            place.alias("place"),
            *([norm.alias("norm")] if text else []),
        )

    @staticmethod
    def _best() -> Column:
        """Of the row that stays: most code points, then smallest id, then first place."""
        return F.min(F.struct((-F.col("points")).alias("less"), F.col("id"), F.col("place")))

    def update(self, path: str) -> None:
        """Adds the Parquet files below path that the state has not seen yet."""
        schema = self.spark.read.parquet(path).schema
        before = {k: self.spark.conf.get(k, None) for k in ROCKSDB}
        try:
            for k, v in ROCKSDB.items():
                self.spark.conf.set(k, v)
            # a pattern, as a streaming source takes no path of a single file otherwise
            stream = self.spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")
            held = self._keyed(stream).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), self._best().alias("best"))
            run = held.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{self.state}/stream").trigger(availableNow=True).start()
            run.awaitTermination()
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def groups(self) -> DataFrame:
        """What the state holds: digest, n, best (less, id, place)."""
        held = self.spark.read.format("statestore").load(f"{self.state}/stream")
        return held.select(F.col("key.digest").alias("digest"), F.col("value.count").alias("n"), F.col("value.min").alias("best"))

    def result(self, path: str, scratch: str | None = None) -> DataFrame:
        """A row for each row below path, which the state must hold: id_column, keep_id, group_size, kept, digest, verified."""
        scratch = scratch or f"{self.state}/result"
        docs = self.spark.read.parquet(path)
        if docs.isEmpty():
            return self.spark.createDataFrame([], f"{self.id_column} long, keep_id long, group_size long, kept boolean, digest string, verified boolean")
        groups = written(self.groups(), f"{scratch}/groups")
        repeated = groups.where("n > 1")
        total = groups.agg(F.sum("n")).first()[0]
        hot = hot_cells(repeated, "digest", "n", total)
        rows = salted_join(self._keyed(docs), repeated, "digest", hot, F.col("id"), "left")
        rows = rows.withColumn("single", F.col("n").isNull()).select("digest", "id", "place", "single", F.coalesce("n", F.lit(1)).alias("n"), F.coalesce("best.id", "id").alias("keep"), F.coalesce("best.place", "place").alias("keep_place"))
        # every hit's bytes against those of the row that its group's locator names
        hits = salted_join(self._keyed(docs, text=True), repeated.select("digest", F.col("best.place").alias("at")), "digest", hot, F.col("id"))
        hits = written(hits.select("digest", "id", "norm", (F.col("place") == F.col("at")).alias("first")), f"{scratch}/hits")
        firsts = hits.where("first").select("digest", F.col("norm").alias("kept_norm"))
        differ = salted_join(hits, firsts, "digest", hot, F.col("id")).where("norm <> kept_norm").select("digest").distinct()
        differ = written(differ, f"{scratch}/collisions")
        sound = rows.join(differ, "digest", "left_anti").withColumn("verified", ~F.col("single"))
        if not differ.isEmpty():
            clashing = self._keyed(docs, text=True).join(differ, "digest")
            exact = clashing.groupBy("norm").agg(F.count(F.lit(1)).alias("n"), self._best().alias("best"))
            sound = sound.unionByName(clashing.join(exact, "norm").select("digest", "id", "place", F.lit(False).alias("single"), "n", F.col("best.id").alias("keep"), F.col("best.place").alias("keep_place"), F.lit(True).alias("verified")))
        return sound.select(
            back_id("id").alias(self.id_column), back_id("keep").alias("keep_id"), F.col("n").alias("group_size"), (F.col("place") == F.col("keep_place")).alias("kept"), "digest", "verified"
        )


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dedup = ExactDedup(spark, shared_dir(spark, "op1"))
    path = f"{sf_dir}/documents.parquet"
    dedup.update(path)
    return dedup.result(path).withColumnRenamed("digest", "text_sha256")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
g AS (SELECT h, count(*) AS n, arg_min(doc_id, struct_pack(a := -points, b := doc_id)) AS keep FROM d GROUP BY h)
SELECT doc_id, keep AS keep_id, n AS group_size, doc_id = keep AS kept, h AS text_sha256, n > 1 AS verified FROM d JOIN g USING (h)
"""
