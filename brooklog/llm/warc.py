"""WARC archives: writing, normalising and reading back.

write_archives makes monolithic archives (one gzip stream a file) as some crawlers do. normalise inflates each stream once, rewrites
every record as a gzip member of its own, and writes a sidecar index with each member's offset and length. read_archives then opens
single members by that index and checks every payload against its digest.

Files are opened with pyarrow.fs, from the URI of a shared folder. Names hold the task attempt, and only files named in the table that a
successful attempt returned are used, so an attempt that dies leaves nothing behind that is read. Records are copied in blocks, so
memory doesn't grow with an archive or a record.

Defined results: a null payload counts as empty; a null id counts as larger than any id; rows that repeat both id and payload are written
alike; an archive is closed at archive_bytes; a null url is written as a URN of the id; an empty table gives no archive and no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import re
import zlib
from collections.abc import Iterator
from functools import partial
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import attempt, back_id, hot_cells, id_of, make_folder, remove, salted_join, shared_dir, text_of, written

MIN_BYTES = 100
ARCHIVE_BYTES = 256_000_000
DATE = "2024-01-01T00:00:00Z"
BLOCK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "archive string, n_records long"


def _urn(page: int) -> str:
    return f"<urn:x-page:{page}>"


def _uri(url: str | None, page: int) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:x-page:{page}"


def record(page: int, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response, or a revisit of the page refers_to without payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _urn(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": _uri(url, page),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _urn(refers_to)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    out = packed = None
    number = records = 0

    def manifest() -> pa.RecordBatch:
        out.write(packed.flush())
        out.close()
        return pa.RecordBatch.from_pydict({"archive": [f"{attempt()}-{number}.warc.gz"], "n_records": [records]})

    for batch in batches:
        for page, url, html, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "html", "digest", "refers_to")), strict=True):
            if out is None:
                out, packed, records = store.open_output_stream(f"{root}/{attempt()}-{number}.warc.gz", compression=None), zlib.compressobj(6, zlib.DEFLATED, 31), 0
            out.write(packed.compress(record(page, url, html.encode(), digest, refers_to)))
            records += 1
            if out.tell() >= archive_bytes:
                yield manifest()
                out, number = None, number + 1
    if out is not None:
        yield manifest()


def revisits(pages: DataFrame, scratch: str, id_column: str = "page_id", payload_column: str = "html", min_bytes: int = MIN_BYTES) -> DataFrame:
    """id, url, html, digest, refers_to: of rows with equal payloads of min_bytes or more, all but that with the smallest id refer to it."""
    payload = text_of(pages, payload_column)
    url = pages["url"] if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(id_of(pages, id_column).alias("id"), url.alias("url"), payload.alias("html"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    groups = rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    groups = written(groups, f"{scratch}/groups")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    repeated = groups.where("n > 1")
    joined = salted_join(rows, repeated.select("digest", "first"), "digest", hot_cells(repeated, "digest", "n", total), F.col("id"), "left")
    return joined.select("id", "url", "html", "digest", F.when(F.col("first") != F.col("id"), F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes monolithic archives; returns the table of their names."""
    folder = make_folder(records.sparkSession, folder)
    return written(records.mapInArrow(partial(_write, folder=folder, archive_bytes=archive_bytes), MANIFEST), f"{folder}/manifest")


def headers(lines: list[bytes]) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.decode().partition(":") for line in lines)}


def _head(stream: BinaryIO) -> list[bytes] | None:
    """The lines of a record's head, its version first; None at the end of the stream."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    out = []
    while line.strip():
        out.append(line)
        line = stream.readline()
    return out


def normalise(source: BinaryIO, target: BinaryIO, level: int = 6) -> Iterator[dict]:
    """Copies the records of a gzip stream to target as members of their own; gives each member's place."""
    with gzip.GzipFile(fileobj=source) as stream:
        at = 0
        while head := _head(stream):
            known = headers(head[1:])
            packed, size, left = zlib.compressobj(level, zlib.DEFLATED, 31), 0, int(known["content-length"])
            size += target.write(packed.compress(b"".join(head) + b"\r\n")) or 0
            start = at
            while left:
                block = stream.read(min(BLOCK, left))
                if not block:
                    raise ValueError("the archive ends within a record")
                left -= len(block)
                size += target.write(packed.compress(block)) or 0
            size += target.write(packed.compress(b"\r\n\r\n") + packed.flush()) or 0
            at = start + size
            yield {"id": known["warc-record-id"], "type": known["warc-type"], "uri": known.get("warc-target-uri"), "digest": known.get("warc-payload-digest"), "offset": start, "length": size}


class _Counted:
    """write() says how much it wrote, which pyarrow's streams may not."""

    def __init__(self, stream):
        self.stream = stream

    def write(self, data: bytes) -> int:
        self.stream.write(data)
        return len(data)


def _normalise(batches: Iterator[pa.RecordBatch], source: str, target: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(source)
    to, to_root = fs.FileSystem.from_uri(target)
    for batch in batches:
        for k, archive in enumerate(batch.column("archive").to_pylist()):
            name, records = f"{attempt()}-{k}-{archive}", 0
            with store.open_input_stream(f"{root}/{archive}", compression=None, buffer_size=BLOCK) as read, to.open_output_stream(f"{to_root}/{name}", compression=None, buffer_size=BLOCK) as write, to.open_output_stream(f"{to_root}/{name}.index", compression=None, buffer_size=BLOCK) as index:
                for place in normalise(read, _Counted(write)):
                    index.write(json.dumps(place).encode() + b"\n")
                    records += 1
            yield pa.RecordBatch.from_pydict({"archive": [name], "n_records": [records]})


def normalise_archives(manifest: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrites the archives that manifest names; returns the table of the new names. Each has a sidecar named .index."""
    spark = manifest.sparkSession
    source, target = make_folder(spark, source), make_folder(spark, target)
    tasks = manifest.repartition(max(1, manifest.count()), "archive")
    return written(tasks.mapInArrow(partial(_normalise, source=source, target=target), MANIFEST), f"{target}/manifest")


RECORDS = "record_id string, record_type string, uri string, payload_digest string, payload_bytes long, refers_to string"


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, root = fs.FileSystem.from_uri(folder)
    names = [x.split()[0] for x in RECORDS.split(", ")]
    for batch in batches:
        for archive in batch.column("archive").to_pylist():
            rows = []
            with store.open_input_stream(f"{root}/{archive}.index", compression=None, buffer_size=BLOCK) as index, store.open_input_file(f"{root}/{archive}") as data:
                for line in io.BufferedReader(index, BLOCK):
                    place = json.loads(line)
                    rows.append(_member(data.read_at(place["length"], place["offset"])))
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=_records_schema(names))
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_records_schema(names))


def _records_schema(names: list[str]) -> pa.Schema:
    return pa.schema([(n, pa.int64() if n == "payload_bytes" else pa.string()) for n in names])


def _member(data: bytes) -> dict:
    """What a member says; the payload of a response must have the length and digest that its heads say."""
    whole = zlib.decompress(data, 31)
    head, _, rest = whole.partition(b"\r\n\r\n")
    known = headers(head.split(b"\r\n")[1:])
    http, _, payload = rest[: int(known["content-length"])].partition(b"\r\n\r\n")
    length = int(headers(http.split(b"\r\n")[1:])["content-length"])
    digest = known["warc-payload-digest"].removeprefix("sha256:")
    if known["warc-type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload of {known['warc-record-id']} is damaged")
    return {"record_id": known["warc-record-id"], "record_type": known["warc-type"], "uri": known["warc-target-uri"], "payload_digest": digest, "payload_bytes": length, "refers_to": known.get("warc-refers-to")}


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """A row for each record of normalised archives."""
    tasks = manifest.repartition(max(1, manifest.count()), "archive")
    return tasks.mapInArrow(partial(_read, folder=make_folder(manifest.sparkSession, folder)), RECORDS)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = shared_dir(spark, "op10")
    records = revisits(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch)
    manifest = write_archives(records, f"{scratch}/monolithic")
    normal = normalise_archives(manifest, f"{scratch}/monolithic", f"{scratch}/warc")
    remove(spark, f"{scratch}/monolithic")
    back = read_archives(normal, f"{scratch}/warc")
    page = lambda c: F.regexp_extract(c, r"^<urn:x-page:(-?\d+)>$", 1).cast("long")
    return back.select(back_id(page("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.when(F.col("refers_to").isNotNull(), back_id(page("refers_to"))).alias("refers_to"))


OP10_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, h AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (h)
"""
