"""Harmonic packing of tokenised documents into sequences.

A document of more ids than the capacity C fills whole sequences; what is left of it, like any shorter document, is a rest. Rests are
partitioned by length into the reciprocal classes (C / (k + 1), C / k], k = 1, 2, ...; a class's open sequence is closed when it has its
fixed number, k, of rests. The space that is left in a closed sequence is filled by cutting a filler: a rest of a document that was cut
anyway, or else the next rest that comes. So other documents that fit a sequence stay whole. Each task fills its own sequences, without
any shuffle, and holds only the rests of its open sequences (fewer than k for class k, so fewer than C ids for a class) and FILLERS
fillers. At its end it puts what is left one after the other into full sequences and at most one sequence for each smaller power of two.
So no sequence needs padding.

Any tokenizer file may be named. One that lower-cases and drops white space between words, as the default does, is recognised by its
own description, and words are then looked up; texts are encoded whole by any other.

Defined results: a null or empty text holds only the end id; every input row is packed, also one that repeats another or has a null id;
an empty table gives no rows; other columns are ignored whatever their names. Rows are the same when a lost task runs again, as they
follow from the partition alone.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections import deque
from collections.abc import Callable, Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from brooklog.llm.common import bounded_batches, own_caches

CAPACITY = 2048
END_ID = 1
#: Words of which a worker keeps the ids, in two generations: when the newer is full, it becomes the older, and that is forgotten.
CACHE_WORDS = 1_000_000
#: Fillers that a task holds.
FILLERS = 64
#: Longer texts are encoded in segments of about so many bytes, cut at white space.
SEGMENT = 4_000_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Ids of whole texts for tokenizers whose pre-tokenizer drops white space: words between ASCII white space are then encoded independently, and repeated words are looked up."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.cache, self.older = Tokenizer.from_file(path), {}, {}
        self.marks = {m: self._encode([m.decode()])[0] for m in (b".", b",")}

    def _encode(self, words: list[str]) -> list[bytes]:
        return [_bytes(x.ids) for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: set[bytes]) -> None:
        """A plain ASCII word's ids are those of its lower-case letters, and of a final mark."""
        cache, older, plain, other = self.cache, self.older, {}, []
        for w in words:
            if w in older:
                cache[w] = older[w]
            elif w.isascii() and b"<" not in w:
                stem, mark = (w[:-1], w[-1:]) if w[-1:] in self.marks and w[-2:-1].isalnum() else (w, b"")
                plain[w] = stem.lower(), mark
            else:
                other.append(w)
        stems = {stem for stem, _ in plain.values() if stem not in cache}
        cache.update({stem: older[stem] for stem in stems if stem in older})
        wanted = [stem for stem in stems if stem not in older]
        cache.update(zip(wanted, self._encode([w.decode() for w in wanted]), strict=True))
        cache.update({w: cache[stem] + self.marks.get(mark, b"") for w, (stem, mark) in plain.items()})
        cache.update(zip(other, self._encode([w.decode() for w in other]), strict=True))

    def __call__(self, text: str) -> bytes:
        """The ids, each as four bytes, the lowest first."""
        data, out, at = text.encode(), [], 0
        while at < len(data):
            end = len(data)
            if end - at > SEGMENT and (space := re.compile(rb"[\x20\x09-\x0D]").search(data, at + SEGMENT)):
                end = space.start()
            words = data[at:end].split()
            if missing := {w for w in words if w not in self.cache}:
                if len(self.cache) + len(missing) > CACHE_WORDS // 2:
                    self.cache, self.older = {}, self.cache
                    missing = set(words)
                self._learn(missing)
            out.append(b"".join(map(self.cache.__getitem__, words)))
            at = end
        return b"".join(out)


class TextEncoder:
    """Ids of whole texts for any tokenizer."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def __call__(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


#: The parts of a tokenizer file by which WordEncoder's look-up of words is right.
BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}

_encoders: dict[str, Callable[[str], bytes]] = {}


def encoder(path: str) -> Callable[[str], bytes]:
    """One for each worker process, which serves many tasks."""
    if path not in _encoders:
        own = json.loads(Path(path).read_text())
        _encoders[path] = WordEncoder(path) if all(own.get(k) == v for k, v in BY_WORDS.items()) else TextEncoder(path)
    return _encoders[path]


Piece = tuple[object, int, int, bytes]  # a document's id, number of ids, start, and the piece's ids of four bytes


def _cut(piece: Piece, size: int) -> tuple[Piece, Piece]:
    doc, total, start, ids = piece
    return (doc, total, start, ids[: 4 * size]), (doc, total, start + size, ids[4 * size :])


class Packer:
    """Places documents; gives back (piece, sequence, offset) as sequences are complete. Sequences count up from first."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[Piece]] = {}
        self.fillers: deque[Piece] = deque()
        self.waiting: list[Piece] = []  # of a closed sequence with space
        self.space = 0
        self.out: list[tuple[Piece, int, int]] = []

    def _place(self, pieces: list[Piece]) -> None:
        """As a sequence."""
        offset = 0
        for p in pieces:
            self.out.append((p, self.next, offset))
            offset += len(p[3]) // 4
        self.next += 1

    def _fill(self) -> None:
        """As much of the waiting sequence's space as there are fillers."""
        while self.space and self.fillers:
            part, rest = _cut(self.fillers.popleft(), self.space)
            self.waiting.append(part)
            self.space -= len(part[3]) // 4
            if rest[3]:
                self.fillers.appendleft(rest)
        if self.waiting and not self.space:
            self._place(self.waiting)
            self.waiting = []

    def add(self, doc, ids: bytes) -> list[tuple[Piece, int, int]]:
        rest: Piece = (doc, len(ids) // 4, 0, ids)
        while len(rest[3]) >= 4 * self.capacity:
            part, rest = _cut(rest, self.capacity)
            self._place([part])
        if rest[3] and (self.space or (rest[2] and len(self.fillers) < FILLERS)):
            self.fillers.append(rest)
            self._fill()
        elif rest[3]:
            k = self.capacity // (len(rest[3]) // 4)
            held = self.open.setdefault(k, [])
            held.append(rest)
            if len(held) == k:
                self.waiting, self.space = self.open.pop(k), self.capacity - sum(len(p[3]) // 4 for p in held)
                self._fill()
        done, self.out = self.out, []
        return done

    def close(self) -> list[tuple[Piece, int, int]]:
        """What is held, one after the other, in full sequences and in the powers of two that make up the rest."""
        self.fillers.extendleft(reversed(self.waiting))
        self.fillers.extend(p for k in sorted(self.open) for p in self.open[k])
        self.open, left = {}, sum(len(p[3]) // 4 for p in self.fillers)
        while left:
            self.waiting, self.space = [], min(self.capacity, 1 << (left.bit_length() - 1))
            left -= self.space
            self._fill()
        done, self.out = self.out, []
        return done


def _pack(batches: Iterator[pa.RecordBatch], path: str, capacity: int, end_id: int) -> Iterator[pa.RecordBatch]:
    own_caches("packing", _encoders.clear)
    encode, packer = encoder(path), Packer(capacity, TaskContext.get().partitionId() << 40)
    names = [x.split()[0] for x in PIECES.split(", ")]
    end = np.array([end_id], "<u4").tobytes()

    def rows(placed: list[tuple]) -> pa.RecordBatch:
        table = [(doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, offset) for (doc, total, start, ids), sequence, offset in placed]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*table, strict=True)], names=names)

    placed: list[tuple] = []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            placed += packer.add(doc_id, encode(text or "") + end)
            if len(placed) > 5000:
                yield rows(placed)
                placed = []
    if placed := placed + packer.close():
        yield rows(placed)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A row for each piece; capacity must be a power of two."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"))
    return rows.mapInArrow(partial(_pack, path=tokenizer, capacity=capacity, end_id=end_id), PIECES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
