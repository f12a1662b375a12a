"""Line deduplication by range-partitioned hashes.

Every line's hash goes into a range partition with a secondary sort by document and position; a range can end within the lines of one
hash, so a line that a third of all documents share is dealt over many tasks. Each task streams its sorted rows once and keeps the
first document of a hash. Where a hash began in an earlier range, the tasks' first and last hashes (two rows a task) tell its first
document. What comes back is not text: a row for each document that loses lines, with a compressed bitmap of the lines to keep.

Defined results: a null or empty text is one empty line; a null doc_id counts as larger than any id; rows that share a doc_id are one
holder, and rows that repeat both id and text lose the same lines; an empty table gives no rows; other columns are ignored whatever
their names.
"""

from __future__ import annotations

import hashlib
import string
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklog.llm.common import WHITE, bounded_batches, id_of, remove, shared_dir, text_of, unused, written

MIN_POINTS = 10
RUNS = "hash binary, id long, text_key long, pos int, n_lines int"


def _hashes(column: pa.Array) -> np.ndarray:
    """The 16-byte values as an array of pairs."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]].view(">u8").reshape(-1, 2)


def _first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by hash, id, text_key, pos: lines to drop (hash null); with hash, those whose first document an earlier range may hold; and, with pos -1, the first document of this range's first and last hash."""
    schema = pa.schema([("hash", pa.binary()), ("id", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32()), ("n_lines", pa.int32())])
    head = last = None  # (hash, first id)
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes, ids = _hashes(batch.column(0)), batch.column(1).to_numpy()
        new = np.r_[True, (hashes[1:] != hashes[:-1]).any(axis=1)]
        run = np.cumsum(new) - 1
        firsts = ids[np.flatnonzero(new)].copy()
        names = [hashes[k].tobytes() for k in (0, -1)]
        if last and last[0] == names[0]:
            firsts[0] = last[1]
        head = head or (names[0], firsts[0])
        first = firsts[run]
        drop, leads = ids != first, (run == 0) & (names[0] == head[0])
        keep = np.flatnonzero(drop | leads)
        table = batch.take(pa.array(keep))
        yield pa.RecordBatch.from_arrays([pa.array([None if d else head[0] for d in drop[keep]], pa.binary()), *table.columns[1:]], schema=schema)
        last = (names[1], firsts[-1])
    if head:
        ends = [head, last]
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in ends], pa.binary()), pa.array([int(i) for _, i in ends], pa.int64()), pa.array([0, 0], pa.int64()), pa.array([-1, -1], pa.int32()), pa.array([0, 0], pa.int32())], schema=schema)


@F.pandas_udf(T.BinaryType())
def _bitmap(dropped, n_lines):
    def one(positions, n):
        bits = np.ones(n, np.uint8)
        bits[positions] = 0
        return zlib.compress(np.packbits(bits).tobytes(), 6)

    return dropped.combine(n_lines, one)


def kept_lines(bitmap: bytes, n: int) -> np.ndarray:
    """Of n lines, which to keep."""
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n).astype(bool)


def text_key(df: DataFrame, text_column: str):
    return F.xxhash64(text_of(df, text_column))


def later_occurrences(rows: DataFrame, path: str) -> DataFrame:
    """Of rows (RUNS), those whose hash is also in a row of a smaller id. What the tasks find is written below path."""
    order = ["hash", "id", "text_key", "pos"]
    runs = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_first_occurrences, RUNS), path)
    begun = runs.where("pos = -1").groupBy("hash").agg(F.min("id").alias("first"))  # two rows a task at most
    carried = runs.where("pos >= 0 AND hash IS NOT NULL").join(F.broadcast(begun), "hash").where("id > first")
    return runs.where("hash IS NULL").unionByName(carried.drop("first"))


def line_bitmaps(docs: DataFrame, scratch: str, id_column: str = "doc_id", text_column: str = "text", min_points: int = MIN_POINTS) -> DataFrame:
    """For each document that loses lines: id, text_key, n_lines, n_dropped, keep (zlib of packed bits, first line first)."""
    bounded_batches(docs.sparkSession)
    lines = F.split(text_of(docs, text_column), "\n", -1)
    rows = docs.select(id_of(docs, id_column).alias("id"), text_key(docs, text_column).alias("text_key"), F.size(lines).alias("n_lines"), F.posexplode(lines).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(WHITE)), string.ascii_uppercase, string.ascii_lowercase)
    rows = rows.withColumn("key", key).where(F.length("key") >= min_points)
    rows = rows.select(F.unhex(F.left(F.sha2(F.col("key").cast("binary"), 256), F.lit(32))).alias("hash"), "id", "text_key", "pos", "n_lines")
    rows = written(rows, f"{scratch}/lines")  # read twice: to sample the ranges, and to sort
    dropped = later_occurrences(rows, f"{scratch}/runs")
    remove(docs.sparkSession, f"{scratch}/lines")
    by_doc = dropped.groupBy("id", "text_key").agg(F.collect_set("pos").alias("dropped"), F.first("n_lines").alias("n_lines"))
    return by_doc.select("id", "text_key", "n_lines", F.size("dropped").alias("n_dropped"), _bitmap("dropped", "n_lines").alias("keep"))


def _apply(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[pa.RecordBatch]:
    """The last three columns are n_lines, n_dropped and keep; place is that of the text."""
    for batch in batches:
        texts = []
        for text, n, keep in zip(batch.column(place).to_pylist(), *(batch.column(batch.num_columns - k).to_pylist() for k in (3, 1)), strict=True):
            if keep is not None:
                text = "\n".join(line for line, k in zip(text.split("\n"), kept_lines(keep, n), strict=True) if k)
            texts.append(text)
        columns = [*batch.columns[:-3], batch.column(batch.num_columns - 2)]
        columns[place] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-3], batch.schema.names[-2]])


def with_kept_text(docs: DataFrame, scratch: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs, the text without dropped lines, with one more column, the last: n_dropped (null: nothing was dropped; with underscores before it where docs has such a column)."""
    maps = line_bitmaps(docs, scratch, id_column, text_column)
    own = {c: unused(c, docs) for c in maps.columns}
    maps = maps.withColumnsRenamed(own)
    rows = docs.withColumns({own["id"]: id_of(docs, id_column), own["text_key"]: text_key(docs, text_column)})
    joined = rows.join(maps, [own["id"], own["text_key"]], "left").select(*docs.columns, *(own[c] for c in ("n_lines", "n_dropped", "keep")))
    return joined.mapInArrow(partial(_apply, place=docs.columns.index(text_column)), joined.drop(own["n_lines"], own["keep"]).schema)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())])
    for batch in batches:
        n_lines, n_dropped, digests = [], [], []
        for text, keep, dropped in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist(), batch.column("n_dropped").to_pylist(), strict=True):
            lines = text.split("\n")
            if keep is not None:
                text = "\n".join(line for line, k in zip(lines, kept_lines(keep, len(lines)), strict=True) if k)
            n_lines.append(len(lines))
            n_dropped.append(dropped or 0)
            digests.append(hashlib.sha256(text.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(digests, pa.string())], schema=schema)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    maps = line_bitmaps(docs, shared_dir(spark, "op9"))
    rows = docs.select("doc_id", id_of(docs).alias("id"), text_key(docs, "text").alias("text_key"), text_of(docs).alias("text"))
    joined = rows.join(maps, ["id", "text_key"], "left").select("doc_id", "text", "keep", "n_dropped")
    return joined.mapInArrow(_digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


OP9_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, ls[p] AS line, p, translate(trim(ls[p], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM d)),
f AS (SELECT k, min(doc_id) AS first FROM l WHERE length(k) >= 10 GROUP BY k),
m AS (SELECT doc_id, p, line, coalesce(first < doc_id, false) AS gone FROM l LEFT JOIN f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
