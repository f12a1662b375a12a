"""Substring deduplication with a log-structured fingerprint index.

Every window of 13 words has a 64-bit fingerprint. The index holds sorted immutable runs, dealt into parts by ranges of the fingerprint:
each run has, for the fingerprints that its batch brought, the smallest document. A new batch's fingerprints are dealt to the parts in
packed arrays; the task of a part sorts them, merge-joins them with the part's file of every run, names the windows that a smaller
document has (hits), and writes the others' file of the new run. More than max_runs runs are compacted into one. So a batch is held
against fingerprints only, never against earlier texts. Batches must come in the order of their ids.

Hits are verified by their words: consecutive windows that the same document has first make a segment, and both documents give the
SHA-256 of its words. Segments that differ (that document has the windows, but not in a row) are verified window by window, and windows
that still differ (equal fingerprints of different words) are resolved among all windows of that fingerprint by their words. Verifying
looks up the documents that hits name.

Files of a part are opened with pyarrow.fs below a shared folder; names hold the task attempt, and a table lists those that count. The
number of parts, by default spark.sql.shuffle.partitions, says what a task holds: its part's share of all fingerprints, a run at a time.

Defined results: a null text has no words; a null id counts as larger than any id and comes back as null; rows that share an id are one
document, and rows that repeat both id and text lose the same words; an empty table gives no rows; other columns are ignored whatever
their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import attempt, bounded_batches, id_of, make_folder, own_caches, remove, shared_dir, text_of, written
from brooklog.llm.words import forget, hashes_of, words_of

WINDOW, MAX_RUNS, BATCHES = 13, 2, 4
#: Base of the fingerprint's polynomial, modulo 2**64; odd, so it has an inverse there.
BASE = 0x9E3779B97F4A7C15 | 3
#: Windows that a task packs at a time; so many for each part, within the bounds.
PACK, LEAST, MOST = 8192, 1 << 19, 1 << 22
#: Requests for digests of one document that are answered with one copy of its text.
REQUESTS = 1000
_U = np.uint64
_powers: list[np.ndarray] = []


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of BASE and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.r_[_U(1), np.full(size - 1, b, _U)], dtype=_U) for b in (BASE, pow(BASE, -1, 1 << 64))]
    return _powers[0][:n], _powers[1][:n]


def fingerprints(hashes: np.ndarray, window: int, bits: int = 64) -> np.ndarray:
    """Of every window of consecutive words; bits: fewer make collisions, for tests."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, _U)
    up, down = _power(len(hashes))
    sums = np.r_[_U(0), np.cumsum(hashes * up, dtype=_U)]
    out = (sums[window:] - sums[:-window]) * down[:n]
    out ^= out >> _U(32)
    out *= _U(0xD6E8FEB86659FD93)
    out ^= out >> _U(32)
    return out if bits == 64 else out >> _U(64 - bits) << _U(64 - bits)


PACKED = "part int, run string, fingerprints binary, places binary, ids binary"
PACKED_ARROW = pa.schema([("part", pa.int32()), ("run", pa.string()), ("fingerprints", pa.binary()), ("places", pa.binary()), ("ids", pa.binary())])


def _packed(batches: Iterator[pa.RecordBatch], window: int, parts: int, bits: int) -> Iterator[pa.RecordBatch]:
    """For each part, sorted fingerprints, and for each its document's place in ids; each document's windows once."""
    own_caches("words", forget)
    most, found, ids, n = min(max(PACK * parts, LEAST), MOST), [], [], 0

    def flush() -> pa.RecordBatch:
        prints = np.concatenate(found)
        places = np.repeat(np.arange(len(ids), dtype=np.uint16), [len(f) for f in found])
        order = np.argsort(prints, kind="stable")
        prints, places = prints[order], places[order]
        edges = np.searchsorted(prints >> _U(32), (np.arange(parts + 1, dtype=_U) << _U(32)) // _U(parts))
        names, rows = np.array(ids, "<i8").tobytes(), []
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), [*edges[1:-1].tolist(), len(prints)], strict=True)):
            if a < b:
                rows.append((k, None, prints[a:b].tobytes(), places[a:b].tobytes(), names))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PACKED_ARROW, strict=True)], schema=PACKED_ARROW)

    for batch in batches:
        for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            prints = np.unique(fingerprints(hashes_of(words_of(text)), window, bits))
            if len(prints):
                found.append(prints)
                ids.append(i)
                n += len(prints)
            if n >= most or len(ids) == 1 << 16:
                yield flush()
                found, ids, n = [], [], 0
    if n:
        yield flush()


MERGED = "kind string, part int, run string, bucket int, ids binary, fingerprints binary, firsts binary"
MERGED_ARROW = pa.schema([("kind", pa.string()), ("part", pa.int32()), ("run", pa.string()), ("bucket", pa.int32()), ("ids", pa.binary()), ("fingerprints", pa.binary()), ("firsts", pa.binary())])
#: Modulus and factor of the generator that deals ids to buckets.
PRIME, FACTOR = 2**31 - 1, 48271


def _bucket(ids: np.ndarray, parts: int) -> np.ndarray:
    return np.mod(ids ^ (ids >> 31), PRIME) * FACTOR % PRIME % parts


def bucket_of(c: Column, parts: int) -> Column:
    """The same from column functions."""
    return (F.pmod(c.bitwiseXOR(F.shiftright(c, 31)), F.lit(PRIME).cast("long")) * FACTOR % PRIME % parts).cast("int")


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    part, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row["part"] != part and held:
                yield part, held
                held = []
            part = row["part"]
            held.append(row)
    if held:
        yield part, held


def _read_run(store: fs.FileSystem, root: str, name: str) -> tuple[np.ndarray, np.ndarray]:
    with store.open_input_file(f"{root}/{name}") as f:
        table = pq.read_table(f)
    return table.column("fingerprint").to_numpy().view(_U) ^ _U(1 << 63), table.column("first").to_numpy()


def _write_run(store: fs.FileSystem, root: str, part: int, prints: np.ndarray, firsts: np.ndarray) -> pa.RecordBatch:
    """Sorted as signed numbers, so that differences are small."""
    name = f"{part}-{attempt()}.parquet"
    table = pa.table({"fingerprint": (prints ^ _U(1 << 63)).view(np.int64), "first": firsts})
    with store.open_output_stream(f"{root}/{name}") as f:
        pq.write_table(table, f, use_dictionary=False, column_encoding="DELTA_BINARY_PACKED", compression="none", write_statistics=False, row_group_size=1 << 20)
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(("run", part, name, None, None, None, None), MERGED_ARROW, strict=True)], schema=MERGED_ARROW)


def _merge(batches: Iterator[pa.RecordBatch], folder: str, parts: int, keep: bool) -> Iterator[pa.RecordBatch]:
    """For each part, the hits of the batch by bucket of their documents, and (keep) the file of the new run."""
    store, root = fs.FileSystem.from_uri(folder)
    for part, rows in _by_part(batches):
        new = [r for r in rows if r["run"] is None]
        if not new:
            continue
        prints = np.concatenate([np.frombuffer(r["fingerprints"], _U) for r in new])
        ids = np.concatenate([np.frombuffer(r["ids"], "<i8")[np.frombuffer(r["places"], np.uint16)] for r in new])
        del new
        order = np.lexsort((ids, prints))
        prints, ids = prints[order], ids[order]
        starts = np.flatnonzero(np.r_[True, prints[1:] != prints[:-1]])
        own, firsts = prints[starts], ids[starts]
        fresh = np.ones(len(own), bool)
        for r in rows:
            if r["run"] is not None:
                known, by = _read_run(store, root, r["run"])
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                old = known[at] == own
                firsts = np.where(old, np.minimum(firsts, by[at]), firsts)
                fresh &= ~old
        first = np.repeat(firsts, np.diff(np.r_[starts, len(prints)]))
        hit = np.flatnonzero(ids > first)
        bucket = _bucket(ids[hit], parts)
        order = np.argsort(bucket, kind="stable")
        hit, edges = hit[order], np.searchsorted(bucket[order], np.arange(parts + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            some = hit[edges[k] : edges[k + 1]]
            row = ("hit", part, None, k, ids[some].astype("<i8").tobytes(), prints[some].tobytes(), first[some].astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, MERGED_ARROW, strict=True)], schema=MERGED_ARROW)
        if keep and fresh.any():
            yield _write_run(store, root, part, own[fresh], firsts[fresh])


def _compact(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    for part, rows in _by_part(batches):
        runs = [_read_run(store, root, r["run"]) for r in rows]
        prints, firsts = (np.concatenate(c) for c in zip(*runs, strict=True))
        del runs
        order = np.argsort(prints, kind="stable")  # a fingerprint is in one run only
        yield _write_run(store, root, part, prints[order], firsts[order])


SEGMENTS = "id long, text_key long, start int, length int, first long, fingerprint long, digest binary"
SEGMENTS_ARROW = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("start", pa.int32()), ("length", pa.int32()), ("first", pa.int64()), ("fingerprint", pa.int64()), ("digest", pa.binary())])


def _digest(words: list[bytes], start: int, length: int, window: int) -> bytes:
    return hashlib.sha256(b" ".join(words[start : start + length + window - 1])).digest()


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True) if found else [[]] * len(schema), schema, strict=True)], schema=schema)


def _segments(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """From the hits of a bucket and then its texts: the segments of the texts that have hits."""
    bucket, held, ids = None, [], None
    for batch in batches:
        out = []
        for at, i, key, text, *packed in zip(*(batch.column(c).to_pylist() for c in ("bucket", "id", "text_key", "text", "ids", "fingerprints", "firsts")), strict=True):
            if at != bucket:
                bucket, held, ids = at, [], None
            if text is None:
                held.append(packed)
                continue
            if ids is None:
                ids, known, firsts = (np.frombuffer(b"".join(h[k] for h in held), t) for k, t in enumerate(("<i8", _U, "<i8")))
                order, held = np.lexsort((known, ids)), []
                ids, known, firsts = ids[order], known[order], firsts[order]
            a, b = np.searchsorted(ids, i, "left"), np.searchsorted(ids, i, "right")
            if a == b:
                continue
            words = words_of(text)
            prints = fingerprints(hashes_of(words), window, bits)
            own = np.minimum(np.searchsorted(known[a:b], prints), b - a - 1)
            places = np.flatnonzero(known[a:b][own] == prints)
            first = firsts[a:b][own[places]]
            starts = np.flatnonzero(np.r_[True, (np.diff(places) != 1) | (np.diff(first) != 0)]) if len(places) else places
            for x, y in zip(starts.tolist(), [*starts[1:].tolist(), len(places)], strict=True) if len(places) else ():
                s, n = int(places[x]), y - x
                out.append((i, key, s, n, int(first[x]), int(prints[s].view(np.int64)), _digest(words, s, n, window)))
        yield _rows(out, SEGMENTS_ARROW)


def _singles(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """From texts and segments: each window as a segment."""
    for batch in batches:
        for i, key, text, parts in zip(*(batch.column(c).to_pylist() for c in ("id", "text_key", "text", "parts")), strict=True):
            words = words_of(text)
            prints = fingerprints(hashes_of(words), window, bits).view(np.int64)
            yield _rows([(i, key, s, 1, p["first"], int(prints[s]), _digest(words, s, 1, window)) for p in parts for s in range(p["start"], p["start"] + p["length"])], SEGMENTS_ARROW)


ANSWERS = "first long, fingerprint long, length int, digest binary"


def _answers(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    """From texts and requests: the digest of each place where a segment with that first fingerprint could be."""
    schema = pa.schema([SEGMENTS_ARROW.field(c.split()[0]) for c in ANSWERS.split(", ")])
    for batch in batches:
        for i, text, requests in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "requests")), strict=True):
            words = words_of(text)
            prints = fingerprints(hashes_of(words), window, bits).view(np.int64)
            order = np.argsort(prints, kind="stable")
            found = set()
            for r in requests:
                a, b = np.searchsorted(prints, [r["fingerprint"]], "left", order)[0], np.searchsorted(prints, [r["fingerprint"]], "right", order)[0]
                for s in order[a:b].tolist():
                    if s + r["length"] <= len(prints):
                        found.add((i, r["fingerprint"], r["length"], _digest(words, s, r["length"], window)))
            yield _rows(list(found), schema)


def _every_window(batches: Iterator[pa.RecordBatch], window: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, key, text in zip(*(batch.column(c).to_pylist() for c in ("id", "text_key", "text")), strict=True):
            words = words_of(text)
            prints = fingerprints(hashes_of(words), window, bits).view(np.int64)
            yield _rows([(i, key, s, 1, None, p, _digest(words, s, 1, window)) for s, p in enumerate(prints.tolist())], SEGMENTS_ARROW)


def kept_words(words: list[bytes], starts: list[int], lengths: list[int], window: int) -> list[bytes]:
    """Without those that the windows of a segment cover."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, np.add(starts, lengths) + (window - 1), -1)
    return [w for w, k in zip(words, (np.cumsum(edges)[: len(words)] == 0).tolist(), strict=True) if k]


CUT = "n_words long, n_removed long, kept_sha256 string"


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist(), strict=True):
            words = words_of(text)
            kept = kept_words(words, [p["start"] for p in parts], [p["length"] for p in parts], window) if parts else words
            out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        columns = zip(*out, strict=True) if out else [[]] * 3
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True))], names=["doc_id", "n_words", "n_removed", "kept_sha256"])


class SubstringIndex:
    """state() names the runs, for an object over the same root that continues later. bits: of the fingerprint, fewer only in tests."""

    def __init__(self, spark: SparkSession, root: str, window: int = WINDOW, max_runs: int = MAX_RUNS, parts: int | None = None, state: str | None = None, bits: int = 64):
        held = json.loads(state) if state else {"batches": 0, "runs": [], "parts": parts or int(spark.conf.get("spark.sql.shuffle.partitions"))}
        self.spark, self.root, self.window, self.max_runs, self.bits = spark, root, window, max_runs, bits
        self.batches, self.runs, self.parts = held["batches"], held["runs"], held["parts"]
        self.files = make_folder(spark, f"{root}/files")
        bounded_batches(spark)

    def state(self) -> str:
        return json.dumps({"batches": self.batches, "runs": self.runs, "parts": self.parts})

    def _known(self) -> DataFrame:
        """part, run: the files of the runs."""
        return self.spark.read.schema("part int, run string").parquet(*self.runs)

    def _compact_runs(self) -> None:
        old, listed = self.runs, f"{self.root}/run-{self.batches}-compacted"
        known = written(self._known(), f"{self.root}/old-{self.batches}")
        rows = known.repartition(self.parts, "part").sortWithinPartitions("part")
        written(rows.mapInArrow(partial(_compact, folder=self.files), MERGED).select("part", "run"), listed)
        self.runs = [listed]
        for row in known.select("run").toLocalIterator():
            remove(self.spark, f"{self.files}/{row['run']}")
        for path in (*old, f"{self.root}/old-{self.batches}"):
            remove(self.spark, path)

    def drop(self) -> None:
        """Removes the runs; tables of hits stay."""
        for path in (self.files, *self.runs):
            remove(self.spark, path)
        self.runs = []

    def add(self, batch: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: bool = True) -> DataFrame:
        """The hits: bucket, ids, fingerprints, firsts (arrays of 64-bit numbers, packed), a row for each part and bucket. keep: the batch enters the index."""
        self.batches += 1
        docs = batch.select(id_of(batch, id_column).alias("id"), text_of(batch, text_column).alias("text"))
        rows = docs.mapInArrow(partial(_packed, window=self.window, parts=self.parts, bits=self.bits), PACKED)
        if self.runs:
            rows = rows.unionByName(self._known(), allowMissingColumns=True)
        rows = rows.repartition(self.parts, "part").sortWithinPartitions("part")
        found = written(rows.mapInArrow(partial(_merge, folder=self.files, parts=self.parts, keep=keep), MERGED), f"{self.root}/hits-{self.batches}", ["kind"])
        if keep:
            listed = f"{self.root}/run-{self.batches}"
            written(found.where("kind = 'run'").select("part", "run").coalesce(1), listed)
            self.runs.append(listed)
            if len(self.runs) > self.max_runs:
                self._compact_runs()
        return found.where("kind = 'hit'").select("bucket", "ids", "fingerprints", "firsts")


def _confirmed(texts: DataFrame, segments: DataFrame, scratch: str, window: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """The segments that the documents they name have too, and the others. texts: id, text."""
    asked = segments.select("first", "fingerprint", "length").distinct()
    many = asked.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / REQUESTS).cast("int").alias("cells")).where("cells > 1")
    cell = F.pmod(F.xxhash64("fingerprint", "length"), F.coalesce("cells", F.lit(1)))
    grouped = asked.join(many, "first", "left").groupBy("first", cell.alias("cell")).agg(F.collect_list(F.struct("fingerprint", "length")).alias("requests"))
    answers = grouped.join(texts, F.col("first") == F.col("id")).select("id", "text", "requests").mapInArrow(partial(_answers, window=window, bits=bits), ANSWERS)
    judged = segments.join(answers.distinct().withColumn("good", F.lit(True)), ["first", "fingerprint", "length", "digest"], "left")
    judged = written(judged, f"{scratch}/judged")
    return judged.where("good").select("id", "text_key", "start", "length"), judged.where("good IS NULL").drop("good")


def cut(docs: DataFrame, hits: DataFrame, scratch: str, parts: int, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, bits: int = 64) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_removed, kept_sha256, without the words of verified hits. docs must hold all documents that hits name; parts: of the index."""
    rows = docs.select(docs[id_column].alias("doc_id"), id_of(docs, id_column).alias("id"), text_of(docs, text_column).alias("text"), F.xxhash64(text_of(docs, text_column)).alias("text_key"))
    texts = rows.select("id", "text_key", "text")
    dealt = texts.withColumn("bucket", bucket_of(F.col("id"), parts)).unionByName(hits, allowMissingColumns=True)
    dealt = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", F.col("text").isNotNull())
    segments = written(dealt.mapInArrow(partial(_segments, window=window, bits=bits), SEGMENTS), f"{scratch}/segments")
    good, other = _confirmed(texts.select("id", "text"), segments, f"{scratch}/whole", window, bits)
    if not other.isEmpty():
        parts = other.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "length", "first")).alias("parts"))
        singles = written(texts.join(parts, ["id", "text_key"]).mapInArrow(partial(_singles, window=window, bits=bits), SEGMENTS), f"{scratch}/singles")
        more, other = _confirmed(texts.select("id", "text"), singles, f"{scratch}/single", window, bits)
        good = good.unionByName(more)
        if not other.isEmpty():
            every = texts.mapInArrow(partial(_every_window, window=window, bits=bits), SEGMENTS).join(other.select("fingerprint").distinct(), "fingerprint")
            every = written(every, f"{scratch}/clashing")
            least = every.groupBy("fingerprint", "digest").agg(F.min("id").alias("least"))
            late = every.join(least, ["fingerprint", "digest"]).where("least < id").select("id", "text_key", "start", "length")
            good = good.unionByName(late)
    parts = good.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "length")).alias("parts"))
    joined = rows.join(parts, ["id", "text_key"], "left").select("doc_id", "text", "parts")
    return joined.mapInArrow(partial(_cut, window=window), f"doc_id {docs.schema[id_column].dataType.simpleString()}, {CUT}")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In BATCHES batches of increasing ids; each is held against the runs of those before, and joins them. The index is dropped in the end."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), shared_dir(spark, "op6")
    index = SubstringIndex(spark, f"{scratch}/index")
    edges = docs.agg(F.percentile_approx("doc_id", [k / BATCHES for k in range(1, BATCHES)], 10_000).alias("at")).first()["at"] or []
    edges, hits = sorted(set(edges)), None
    for k in range(len(edges) + 1):
        inside = F.lit(True) if k == 0 else F.col("doc_id") > edges[k - 1]
        inside = inside & (F.col("doc_id") <= edges[k]) if k < len(edges) else inside | F.col("doc_id").isNull()
        found = index.add(docs.where(inside))
        hits = found if hits is None else hits.unionByName(found)
    index.drop()
    return cut(docs, hits, scratch, index.parts)


OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, p, array_to_string(ws[p:p + 12], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)),
f AS (SELECT k, min(doc_id) AS first FROM w GROUP BY k),
gone AS (SELECT DISTINCT doc_id, p + o AS p FROM (SELECT doc_id, p FROM w JOIN f USING (k) WHERE first < doc_id), (SELECT unnest(range(13)) AS o)),
s AS (SELECT doc_id, p, ws[p] AS x FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
m AS (SELECT s.doc_id, s.p, s.x, gone.p IS NOT NULL AS g FROM s LEFT JOIN gone ON s.doc_id = gone.doc_id AND s.p = gone.p),
a AS (SELECT doc_id, count(*) FILTER (g) AS n, string_agg(x, ' ' ORDER BY p) FILTER (NOT g) AS kept FROM m GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (doc_id)
"""
