"""N-gram Jaccard join: rare-first prefix filtering with length, positional and suffix filters, each pair verified once.

Documents with equal shingle sets are one class, so copies cost one row each. Shingles are ordered by a count of their documents, rarest
first, and then by their hash; a class enters the index with its prefix only. The counts come from all documents and are kept in a table
of fixed size (SKETCH counters, hashed), which is what makes its broadcast bounded; a shared counter only makes the order less sharp, as
any fixed order gives the same links.

The index is dealt by prefix shingle and sorted by set size; a class stays in the bucket of a shingle only if a neighbour there passes
the length filter. Then each class has the list of the shared shingles of its prefix, and its row in a bucket knows those that come
before. (Before that, rows are dropped that pass the filters with no other of their bucket, which most do.) A pair is a candidate in the bucket of its first common prefix shingle and in no other, so every pair is judged once: by the
positional filter at that shingle, and by the suffix filter (numbers of shingles in RANGES fixed parts of the hash's values, modulo 16,
which bound the number of shingles in one set only). Candidates are never rows: a task finds them within a bucket, and names the classes
that are in any. Only these get their texts (found through a broadcast of BITS bits, 8 MiB), once for each bucket, and the same candidates are then verified by comparing the words of
their shingles. Buckets of more than CELL classes are dealt over pairs of cells, so a task holds the texts of two cells.

result() gives each document its component and its number of links; for that a task returns, of the pairs it verified, each class's
number of linked documents and a forest of links, so rows don't grow with the square of a group. pairs() returns all links between
classes, as pairs of the documents that stand for them. The work on a group of n near copies does grow with n * n, as its links do.

Defined results: null or empty texts, and rows with a null id, are linked with nothing; rows that share an id count as one document in
components and have its links; an empty table gives no rows; other columns are ignored whatever their names. Two sets count as equal if their 64-bit
shingle hashes have the same 128-bit digest.
"""

from __future__ import annotations

import zlib
from collections import OrderedDict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import bounded_batches, hot_cells, own_caches, release, remove, salted_join, shared_dir, written
from brooklog.llm.components import components
from brooklog.llm.words import forget, shingles, words_of

WORDS, PERCENT = 5, 80
SKETCH, CHUNKS = 1 << 20, 64
#: Classes of which a task remembers that it has indexed them; a repeat is dropped in its bucket anyhow.
SEEN = 50_000
#: Parts of the hash's values in the suffix filter.
RANGES = 128
#: Classes of a bucket in a cell.
CELL = 128
#: Bits of the table of ids whose texts are looked up; ids that share one cost the sending of a text, never a result.
BITS = 1 << 26
CLASS = ["c1", "c2"]
KEY = ["token", "low", "high"]
MEMBER = "token long, low int, high int, own int, c1 long, c2 long, n int, pos int, signature binary, prior array<long>, size long, rep long"


def least_overlap(n, percent: int):
    """Of a set of size n with any that links to it."""
    return -(-percent * n // 100)


def class_of(tokens: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(tokens.tobytes())
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)


def signature(tokens: np.ndarray) -> bytes:
    """Numbers of tokens in RANGES equal parts of the hash's values, modulo 16, two in a byte."""
    counts = np.bincount((tokens >> np.uint64(65 - RANGES.bit_length())).astype(np.int64), minlength=RANGES) & 15
    return (counts[::2] | counts[1::2] << 4).astype(np.uint8).tobytes()


def _classes(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each document; and rows with the task's counts, in chunks (n is the chunk)."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("bytes", pa.binary()), ("counts", pa.bool_())])
    own_caches("words", forget)
    counts = np.zeros(SKETCH, np.int32)
    for batch in batches:
        rows = []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            tokens = shingles(text, words)
            np.add.at(counts, _counter(tokens), 1)
            named = i is not None and len(tokens)
            rows.append((i, len(tokens), *(class_of(tokens) if named else (None, None)), signature(tokens) if named else None, False))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    if counts.any():
        none = pa.nulls(CHUNKS, pa.int64())
        packed = pa.array([zlib.compress(x.astype("<i4").tobytes(), 1) for x in np.split(counts, CHUNKS)], pa.binary())
        yield pa.RecordBatch.from_arrays([none, pa.array(range(CHUNKS), pa.int64()), none, none, packed, pa.array([True] * CHUNKS)], schema=schema)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(counts), "<i4").astype(np.int64)
    for chunk, total in sums.items():
        yield pa.RecordBatch.from_pydict({"chunk": [chunk], "counts": [np.minimum(total, 2**31 - 1).astype("<i4").tobytes()]})


def _index(batches: Iterator[pa.RecordBatch], words: int, percent: int, sketch: Broadcast) -> Iterator[pa.RecordBatch]:
    """A row for each shingle of a class's prefix."""
    counts, seen = np.frombuffer(sketch.value, "<i4"), OrderedDict()
    names, kinds = ["token", "c1", "c2", "n", "pos"], [np.int64, np.int64, np.int64, np.int32, np.int32]
    for batch in batches:
        parts: list[list[np.ndarray]] = [[] for _ in names]
        for text in batch.column(0).to_pylist():
            tokens = shingles(text, words)
            if not len(tokens) or (c := class_of(tokens)) in seen:
                continue
            seen[c] = None
            if len(seen) > SEEN:
                seen.popitem(last=False)
            size = len(tokens) - least_overlap(len(tokens), percent) + 1
            prefix = tokens[np.lexsort((tokens, counts[_counter(tokens)]))[:size]].view(np.int64)
            for part, value, kind in zip(parts, (prefix, c[0], c[1], len(tokens), np.arange(size)), kinds, strict=True):
                part.append(np.broadcast_to(np.asarray(value, kind), size))
        if parts[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], names=names)


def _neighbours(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token, n, class: each class once in a bucket, if the next smaller or larger one there passes the length filter."""
    held = None  # the last row so far, and whether the one before it is near
    for batch in batches:
        if not batch.num_rows:
            continue
        if held:
            batch = pa.Table.from_batches([held[0], batch]).combine_chunks().to_batches()[0]
        token, c1, c2, n = (batch.column(c).to_numpy() for c in ("token", "c1", "c2", "n"))
        new = np.r_[True, (token[1:] != token[:-1]) | (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])]
        if not new.all():
            batch = batch.filter(pa.array(new))
            token, n = token[new], n[new]
        n = n.astype(np.int64)
        near = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
        before = np.r_[held[1] if held else False, near]
        keep = before[:-1] | near
        yield batch.slice(0, len(n) - 1).filter(pa.array(keep))
        held = batch.slice(len(n) - 1), bool(before[-1])
    if held and held[1]:
        yield held[0]


def _apart(numbers: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """At least how many shingles of two members are in one only."""
    apart = (numbers[x] - numbers[y]) & 15
    return np.minimum(apart, 16 - apart).sum(axis=1)


def _numbers(packed: np.ndarray) -> np.ndarray:
    return np.concatenate([packed & 15, packed >> 4], axis=1)


POSSIBLE = "token long, c1 long, c2 long, n int, pos int"


def _possible(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """From rows sorted by KEY: those that pass the length, positional and suffix filters with another of their cell."""

    def judged(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [batch.column(c).to_numpy() for c in KEY]
        n, pos, own = (batch.column(c).to_numpy().astype(np.int64) for c in ("n", "pos", "own"))
        numbers = _numbers(np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint8).reshape(len(n), -1))
        new = np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])]
        ends = np.r_[np.flatnonzero(new)[1:], len(n)][np.cumsum(new) - 1]
        across, keep, first = keys[1] != keys[2], np.zeros(len(n), bool), np.arange(len(n))
        step = 1
        while len(first):
            first = first[first + step < ends[first]]
            for k in range(0, len(first), 1 << 13):
                x = first[k : k + (1 << 13)]
                y = x + step
                overlap = -(-percent * (n[x] + n[y]) // (100 + percent))
                good = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (np.minimum(n[x] - pos[x], n[y] - pos[y]) >= overlap) & (~across[x] | (own[x] != own[y]))
                x, y, overlap = x[good], y[good], overlap[good]
                good = n[x] + n[y] - _apart(numbers, x, y) >= 2 * overlap
                keep[x[good]] = keep[y[good]] = True
            step += 1
        return batch.filter(pa.array(keep)).select(["token", *CLASS, "n", "pos"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        last = [batch.column(c)[batch.num_rows - 1] for c in KEY]
        at = int(np.logical_and.reduce([batch.column(c).to_numpy() == v.as_py() for c, v in zip(KEY, last, strict=True)]).argmax())
        if at:
            yield judged(batch.slice(0, at))
        held = batch.slice(at)
    if held is not None:
        yield judged(held)


class Cell:
    """The members of a bucket that stand against each other, and their candidate pairs."""

    def __init__(self, rows: dict[str, list], percent: int):
        once = {c: k for k, c in enumerate(zip(rows["c1"], rows["c2"], strict=True))}  # a class's text comes more than once where rows share an id
        self.rows, self.percent = {c: [v[k] for k in once.values()] for c, v in rows.items()} if len(once) < len(rows["n"]) else rows, percent

    def candidates(self) -> list[tuple[int, int]]:
        """Places of members whose first common prefix shingle is this bucket's and that pass the length, positional and suffix filters."""
        rows, percent = self.rows, self.percent
        n, pos, own = (np.array(rows[c], np.int64) for c in ("n", "pos", "own"))
        allowed = np.triu(np.ones((len(n), len(n)), bool), 1) if rows["low"][0] == rows["high"][0] else (own[:, None] == rows["low"][0]) & (own == rows["high"][0])
        overlap = -(-percent * (n[:, None] + n) // (100 + percent))
        allowed &= 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
        allowed &= np.minimum((n - pos)[:, None], n - pos) >= overlap
        a, b = np.nonzero(allowed)
        if not len(a):
            return []
        numbers = _numbers(np.frombuffer(b"".join(rows["signature"]), np.uint8).reshape(len(n), -1))
        out, before = [], {}
        for k in range(0, len(a), 1 << 12):
            x, y = a[k : k + (1 << 12)], b[k : k + (1 << 12)]
            good = n[x] + n[y] - _apart(numbers, x, y) >= 2 * overlap[x, y]
            for i, j in zip(x[good].tolist(), y[good].tolist(), strict=True):
                for p in (i, j):
                    if p not in before:
                        before[p] = frozenset(rows["prior"][p])
                if before[i].isdisjoint(before[j]):
                    out.append((i, j))
        return out

    def links(self, words: int) -> list[tuple[int, int]]:
        """The candidates that link, by the words of their shingles; members whose text is of another class are in none."""
        numbers: dict[tuple, int] = {}
        sets: dict[int, np.ndarray] = {}

        def numbered(k: int) -> np.ndarray:
            if k not in sets:
                ws = words_of(self.rows["text"][k], lower=True)
                size = min(words, len(ws))
                own = set(zip(*(ws[i : len(ws) - size + 1 + i] for i in range(size)), strict=True)) if size else set()
                sets[k] = np.fromiter((numbers.setdefault(x, len(numbers)) for x in own), np.int64, len(own))
            return sets[k]

        out, marks, marked = [], np.zeros(0, bool), None
        for i, j in self.candidates():
            a, b = numbered(i), numbered(j)
            if marked != i or len(marks) < len(numbers):
                marks = np.zeros(len(numbers), bool)
                marks[a] = True
                marked = i
            both = int(marks[b].sum())
            if 100 * both >= self.percent * (len(a) + len(b) - both):
                out.append((i, j))
        return out


def _cells(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[Cell]:
    """From rows sorted by KEY: one cell after the other."""
    held: dict[str, list] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in KEY]
        starts = np.flatnonzero(np.r_[True, np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
        ends = np.r_[starts[1:], batch.num_rows]
        rows = {f.name: batch.column(f.name).to_pylist() for f in batch.schema}
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            part = {c: v[a:b] for c, v in rows.items()}
            if held and all(held[c][0] == part[c][0] for c in KEY):
                for c, v in part.items():
                    held[c] += v
                continue
            if held and len(held["n"]) > 1:
                yield Cell(held, percent)
            held = part
    if held and len(held["n"]) > 1:
        yield Cell(held, percent)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _partnered(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The members that are in a candidate pair of their cell."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    schema = pa.schema([(c, kinds[t]) for c, t in (x.split() for x in MEMBER.split(", "))])
    out: list[tuple] = []
    for cell in _cells(batches, percent):
        for k in sorted({k for pair in cell.candidates() for k in pair}):
            out.append(tuple(cell.rows[f.name][k] for f in schema))
        if len(out) >= 2000:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


FOUND = "rep long, other long, links long"


def _verified(batches: Iterator[pa.RecordBatch], words: int, percent: int, every: bool) -> Iterator[pa.RecordBatch]:
    """every: all links, by their documents. Else a forest of them, and (other null) for each document the number of documents that its class is linked with."""
    schema = pa.schema([(x.split()[0], pa.int64()) for x in FOUND.split(", ")])
    out: list[tuple] = []

    def same_class(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[str, tuple] = OrderedDict()
        for batch in part:
            good = []
            for text, *c in zip(*(batch.column(x).to_pylist() for x in ("text", *CLASS)), strict=True):
                if text not in known:
                    known[text] = class_of(shingles(text, words))
                    if len(known) > 16:
                        known.popitem(last=False)
                good.append(known[text] == tuple(c))
            yield batch.filter(pa.array(good, pa.bool_()))

    for cell in _cells(same_class(batches), percent):
        reps, sizes = cell.rows["rep"], cell.rows["size"]
        root, linked = list(range(len(reps))), {}

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = k = root[root[k]]
            return k

        for i, j in cell.links(words):
            if every:
                out.append((min(reps[i], reps[j]), max(reps[i], reps[j]), None))
                continue
            linked[i], linked[j] = linked.get(i, 0) + sizes[j], linked.get(j, 0) + sizes[i]
            x, y = top(i), top(j)
            if x != y:
                root[x] = y
                out.append((reps[i], reps[j], None))
        out += [(reps[k], None, v) for k, v in linked.items()]
        if len(out) >= 2000:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


class NgramJoin:
    def __init__(self, docs: DataFrame, scratch: str, words: int = WORDS, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text"):
        self.spark, self.scratch, self.words, self.percent = docs.sparkSession, scratch, words, percent
        self.docs = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
        self.classes = self.firsts = self.members = None
        bounded_batches(self.spark)

    def _prepare(self) -> None:
        """classes (a row a document), firsts (a row a class) and members (a row for each class with its text in a cell where it has a candidate)."""
        if self.members is not None:
            return
        spark, scratch, words, percent = self.spark, self.scratch, self.words, self.percent
        both = written(self.docs.mapInArrow(partial(_classes, words=words), "id long, n long, c1 long, c2 long, bytes binary, counts boolean"), f"{scratch}/classes")
        self.classes = both.where("NOT counts").select("id", "n", *CLASS)
        counts = both.where("counts").select("n", "bytes").repartition(CHUNKS, "n").mapInArrow(_added, "chunk long, counts binary").collect()  # CHUNKS rows, SKETCH counters
        sketch = spark.sparkContext.broadcast(b"".join(r["counts"] for r in sorted(counts, key=lambda r: r["chunk"])) or bytes(4 * SKETCH))
        grouped = both.where("NOT counts AND c1 IS NOT NULL").groupBy(*CLASS)
        self.firsts = written(grouped.agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("rep"), F.first("bytes").alias("signature")), f"{scratch}/firsts")

        texts = self.docs.where("id IS NOT NULL AND text IS NOT NULL")
        entries = texts.select("text").mapInArrow(partial(_index, words=words, percent=percent, sketch=sketch), "token long, c1 long, c2 long, n int, pos int")
        near = entries.repartition("token").sortWithinPartitions("token", "n", *CLASS).mapInArrow(partial(_neighbours, percent=percent), entries.schema)
        near = written(near, f"{scratch}/near")
        sketch.unpersist()

        signed = self._dealt(self._with_cells(near).join(self.firsts.select(*CLASS, "signature"), CLASS))
        possible = signed.select(*KEY, "own", *CLASS, "n", "pos", "signature").repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(partial(_possible, percent=percent), POSSIBLE)
        possible = written(possible, f"{scratch}/possible")
        remove(spark, f"{scratch}/near")

        # the shared shingles of each class's prefix, in order; a row in a bucket knows those before its own
        counted = self._with_cells(possible.distinct())
        shared = counted.groupBy(*CLASS).agg(F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "token", "cells"))).alias("shared"))
        rows = shared.join(self.firsts, CLASS).select(*CLASS, "n", "signature", "size", "rep", F.col("shared.token").alias("tokens"), F.posexplode("shared").alias("k", "x"))
        rows = self._dealt(rows.select(*CLASS, "n", "signature", "size", "rep", F.col("x.token").alias("token"), F.col("x.pos").alias("pos"), F.col("x.cells").alias("cells"), F.expr("slice(tokens, 1, k)").alias("prior")))
        rows = rows.select(*(c.split()[0] for c in MEMBER.split(", ")))
        members = rows.repartition(*KEY).sortWithinPartitions(*KEY).mapInArrow(partial(_partnered, percent=percent), MEMBER)
        members = written(members, f"{scratch}/members")
        remove(spark, f"{scratch}/possible")
        asked = written(members.select(F.col("rep").alias("id")).distinct(), f"{scratch}/asked")
        wanted = self._screened(texts, asked).hint("merge")  # the same plan at every size
        self.members = written(members.join(wanted, F.col("rep") == F.col("id")).drop("id"), f"{scratch}/texts")
        remove(spark, f"{scratch}/members")
        remove(spark, f"{scratch}/asked")

    @staticmethod
    def _screened(texts: DataFrame, asked: DataFrame) -> DataFrame:
        """Without most of the texts that are not asked for, before they are sent: one bit for each hashed id, in BITS bits whatever the data."""
        bit = F.pmod(F.xxhash64("id"), F.lit(BITS)) + 1  # the first bucket of a bitmap begins at 1
        bits = asked.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        rows = texts.withColumn("bucket", F.bitmap_bucket_number(bit)).withColumn("at", F.bitmap_bit_position(bit))
        rows = rows.join(F.broadcast(bits), "bucket")  # BITS / 32768 rows of 4 KiB at most
        byte = F.conv(F.hex(F.expr("substring(bits, CAST(at DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
        return rows.where(byte.bitwiseAND(F.expr("shiftleft(1, CAST(at % 8 AS INT))")) != 0).select("id", "text")

    @staticmethod
    def _with_cells(rows: DataFrame) -> DataFrame:
        """With the number of cells of each row's bucket; asked of rows without signatures and prefixes, as they are sent by token for it."""
        large = rows.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("cells")).where("cells > 1")
        return rows.join(large, "token", "left").withColumn("cells", F.coalesce("cells", F.lit(1)))

    @staticmethod
    def _dealt(rows: DataFrame) -> DataFrame:
        """With low, high, own: each row of a bucket of `cells` cells in all pairs of cells that have its own one."""
        rows = rows.withColumn("own", F.pmod(F.xxhash64(*CLASS), F.col("cells")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        return rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))

    def _judged(self, every: bool) -> DataFrame:
        self._prepare()
        cells = self.members.repartition(*KEY).sortWithinPartitions(*KEY)
        return cells.mapInArrow(partial(_verified, words=self.words, percent=self.percent, every=every), FOUND)

    def pairs(self) -> DataFrame:
        """All links between classes, once each: u < v, the documents that stand for them (smallest id with the same shingles)."""
        return self._judged(every=True).select(F.col("rep").alias("u"), F.col("other").alias("v"))

    def result(self) -> DataFrame:
        """A row for each document: id, n_shingles, component, class_rep (smallest id with the same shingles), n_links (other documents linked with it)."""
        spark, scratch = self.spark, self.scratch
        judged = written(self._judged(every=False), f"{scratch}/links")
        remove(spark, f"{scratch}/texts")
        self.members = None
        found = components(judged.where("other IS NOT NULL").select(F.col("rep").alias("u"), F.col("other").alias("v")), f"{scratch}/components")
        linked = judged.where("other IS NULL").groupBy("rep").agg(F.sum("links").alias("links"))
        joined = self.firsts.join(found, F.col("rep") == F.col("node"), "left").join(linked, "rep", "left")
        joined = joined.select(*CLASS, "size", "rep", F.coalesce("component", "rep").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
        joined = written(joined, f"{scratch}/joined")
        total = joined.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
        hot = hot_cells(joined.withColumn("key", F.struct(*CLASS)), "key", "size", total).select("key.c1", "key.c2", "cells")
        out = salted_join(self.classes, joined.drop("size"), CLASS, hot, F.col("id"), "left")
        release(spark)
        return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"), F.coalesce("rep", "id").alias("class_rep"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = NgramJoin(spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "op4"), words=3, percent=90).result()
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "class_rep", "n_links")
