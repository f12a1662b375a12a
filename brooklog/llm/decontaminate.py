"""Benchmark decontamination by q-gram lemma filtering.

A document leaks an item if some passage of it is within the item's edit budget, at most a tenth of its characters, after both are
lower-cased and their runs of anything but letters and digits made one space. An occurrence with e edits of an item of m characters
keeps at least m + 1 - q * (e + 1) of its q-grams, on diagonals (place in the document less place in the item) that differ by at most
2 * e. So the different item q-grams that a document shares are counted in diagonal bands twice as wide as that which overlap by half;
bands that reach the bound are verified by an alignment within the band, and long stretches of such bands, as repetitive texts have,
by one scan with bit vectors. The filter drops no occurrence within the budget. For one gram, of the places of a text in a cell as wide
as a band only the first and the last are held against the item's places, as they give all its bands; and these are looked at EXPANDED
pairs at a time, so neither repetitive texts nor repetitive items take more memory than their length.

The items are a stated query set: they are collected in blocks of at most block_chars characters in expectation, chosen by a hash, and
each block is held against all documents. Documents are read in segments, so memory doesn't grow with a text.

Items of fewer than min_chars characters, or than q, have no edits and are searched as whole words: at the starts of words, of exactly
their characters up to the end of a word.

Defined results: null or empty texts leak nothing; items that are null or have no letter or digit are not searched; for each row and item the nearest passage counts, on ties the first; rows that repeat are each judged; empty tables give no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import bounded_batches

Q, BUDGET, MIN_CHARS, BLOCK_CHARS, SEGMENT = 8, 0.1, 24, 4_000_000, 1 << 20
HASH_BITS = 20
#: Pairs of places that are looked at together, and bands in a row that are aligned one by one.
EXPANDED, FEW = 1 << 20, 4
#: Characters of an item from which on a band is scanned, as its width grows with the item.
WIDE = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
HITS = "item_id long, distance int, item_chars int, start long, end long"


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """Each code point's lower case if it is a letter or digit, else a space."""

    def one(i: int) -> int:
        c = chr(i)
        if not c.isalnum():
            return 32
        return ord(c.lower()) if len(c.lower()) == 1 else i

    return np.fromiter(map(one, range(0x110000)), np.uint32, 0x110000)


def normalised(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, with single spaces between runs and none at the ends; and the place of each in the text."""
    points = _table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    solid = points != 32
    keep = solid.copy()
    keep[1:] |= solid[:-1]  # the first space after a run
    at = np.flatnonzero(keep)
    if len(at) and points[at[-1]] == 32:
        at = at[:-1]
    return points[at], at


def budget(m: int, q: int = Q, share: float = BUDGET) -> int:
    """Edits allowed for m characters: so many that the lemma's bound stays positive."""
    return max(0, min(int(m * share), (m + 1 - 1) // q - 1))


def grams(points: np.ndarray, q: int) -> np.ndarray:
    n = max(0, len(points) - q + 1)
    out = np.zeros(n, np.uint64)
    for k in range(q):
        out *= BASE
        out += points[k : k + n]
    out ^= out >> np.uint64(29)
    return out * BASE


class Items:
    """The q-grams of a block of items, sorted by hash, with their items and places."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q, share: float = BUDGET, min_chars: int = MIN_CHARS):
        every = [(i, p) for i, t in items if t and len(p := normalised(t)[0])]
        kept, short = [x for x in every if len(x[1]) >= max(min_chars, q)], [x for x in every if len(x[1]) < max(min_chars, q)]
        self.q, self.ids, self.points = q, [i for i, _ in kept], [p for _, p in kept]
        self.sizes = np.array([len(p) for p in self.points], np.int64)
        self.edits = np.array([budget(len(p), q, share) for p in self.points], np.int64)
        self.bounds = self.sizes + 1 - q * (self.edits + 1)
        # short items are numbered after the others; by size: the hashes of their texts, and the numbers by text
        self.all_ids, self.all_sizes = [i for i, _ in kept + short], [len(p) for _, p in kept + short]
        texts: dict[int, dict[bytes, list[int]]] = {}
        for k, (_, p) in enumerate(short, len(kept)):
            texts.setdefault(len(p), {}).setdefault(p.tobytes(), []).append(k)
        self.short = {m: (np.concatenate([grams(np.frombuffer(t, np.uint32), m) for t in found]), found) for m, found in texts.items()}
        hashes = [grams(p, q) for p in self.points]
        keys = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(keys, kind="stable")
        self.item = np.repeat(np.arange(len(kept)), [len(h) for h in hashes])[order] if kept else np.empty(0, np.int64)
        self.place = np.concatenate([np.arange(len(h)) for h in hashes])[order] if kept else np.empty(0, np.int64)
        self.keys, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.gram = np.repeat(np.arange(len(self.keys)), self.count)
        by_item = np.argsort(self.item, kind="stable")
        self.entries = np.split(by_item, np.cumsum(np.bincount(self.item, minlength=len(kept)))[:-1]) if kept else []
        self.filter = np.zeros(1 << HASH_BITS, bool)
        self.filter[(self.keys >> np.uint64(64 - HASH_BITS)).astype(np.int64)] = True


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, fixed: bool = False) -> tuple[int, int]:
    """The least edit distance of the item to a passage of text on diagonals low to high, and the passage's end; fixed: that starts at 0."""
    far = len(item) + len(text) + 1
    width = high - low + 1
    steps = np.arange(width)
    row = np.full(width, far)
    start = steps + low
    row[(start >= 0) & (start <= len(text))] = 0
    if fixed:
        row = np.where((start >= 0) & (start <= len(text)), start, far)
    padded = np.concatenate([np.full(max(0, -low) + 1, 0x110000), text, np.full(max(0, len(item) + high - len(text)) + 1, 0x110000)]).astype(np.int64)
    base = low + max(0, -low) + 1
    for i, c in enumerate(item):
        cost = row + (padded[base + i : base + i + width] != c)  # row holds D[i][i + diagonal]
        cost[:-1] = np.minimum(cost[:-1], row[1:] + 1)
        column = steps + low + i + 1
        cost[(column < 0) | (column > len(text))] = far
        row = np.minimum.accumulate(cost - steps) + steps
        row[(column < 0) | (column > len(text))] = far
    best = int(np.argmin(row))
    return int(row[best]), best + low + len(item)


def short_leaks(points: np.ndarray, items: Items) -> dict[int, tuple[int, int]]:
    """By number of each short item that a normalised text has as whole words: the first place and its end."""
    out: dict[int, tuple[int, int]] = {}
    spaces = np.flatnonzero(points == 32)
    starts, is_end = np.r_[0, spaces + 1], np.zeros(len(points) + 1, bool)
    is_end[spaces] = is_end[len(points)] = True
    for m, (keys, texts) in items.short.items():
        at = starts[starts + m <= len(points)]
        at = at[is_end[at + m]]
        for k in range(0, len(at), SEGMENT):
            part = at[k : k + SEGMENT]
            hashes = np.zeros(len(part), np.uint64)
            for j in range(m):
                hashes *= BASE
                hashes += points[part + j]
            hashes ^= hashes >> np.uint64(29)
            for place in part[np.isin(hashes * BASE, keys)].tolist():
                for n in texts.get(points[place : place + m].tobytes(), ()):
                    out.setdefault(n, (place, place + m))
    return out


def scan(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """The least edit distance of the item to any passage of text, and the first end of such a passage: columns of differences as bit vectors."""
    m, masks = len(item), {}
    whole, part, place = text.tobytes(), item.tobytes(), -1
    while (place := whole.find(part, place + 1)) >= 0:
        if place % item.itemsize == 0:
            return 0, place // item.itemsize + m
    for i, c in enumerate(item.tolist()):
        masks[c] = masks.get(c, 0) | 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    more, fewer, score = every, 0, m
    best = (m, 0)
    for at, c in enumerate(text.tolist(), 1):
        equal = masks.get(c, 0)
        vertical = equal | fewer
        horizontal = (((equal & more) + more) ^ more) | equal
        up = fewer | (every & ~(horizontal | more))
        down = more & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best[0]:
                best = score, at
        up, down = up << 1 & every, down << 1 & every
        more = down | (every & ~(vertical | up))
        fewer = up & vertical
    return best


def bands(where: np.ndarray, starts: np.ndarray, counts: np.ndarray, places: np.ndarray, wide: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Bands, and how many of the item's places each shares. Entry i is one place of the item, with its gram's places in the text, in order, at where[starts[i]:][:counts[i]]."""
    grams, at = np.unique(starts, return_index=True)
    pruned, first, n = [], np.zeros(len(grams), np.int64), 0
    for g, k in enumerate(at.tolist()):
        t = where[starts[k] : starts[k] + counts[k]]
        if len(t) > 2:
            new = np.r_[True, t[1:] // wide != t[:-1] // wide, True]
            t = t[new[:-1] | new[1:]]
        pruned.append(t)
        first[g], n = n, n + len(t)
    where, sizes = np.concatenate(pruned), np.array([len(t) for t in pruned])
    own = np.searchsorted(grams, starts)
    counts, starts = sizes[own], first[own]
    low = (int(where.min()) - m) // wide
    totals = np.zeros((int(where.max()) // wide) - low + 3, np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(counts) // EXPANDED, prepend=-1))
    for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(counts)], strict=True):
        c = counts[a:b]
        rows = np.repeat(starts[a:b] - np.cumsum(c) + c, c) + np.arange(c.sum())
        place = np.repeat(places[a:b], c)
        band = (where[rows] - place) // wide - low
        # band b has diagonals (b - 1) * wide to (b + 1) * wide - 1; each place counts once in it
        keys = np.unique(np.concatenate([band * m + place, (band + 1) * m + place]))
        totals += np.bincount(keys // m, minlength=len(totals))
    found = np.flatnonzero(totals)
    return found + low, totals[found]


def leaks(text: str, items: Items) -> list[tuple[int, int, int, int]]:
    """(number of the item, distance, start, end) for each item that the text leaks; code points of the text."""
    q, best = items.q, {}
    if not len(items.keys) and not items.short:
        return []
    whole, places = normalised(text)
    if items.short and len(whole):
        best = {n: (0, int(places[a]), int(places[b - 1]) + 1) for n, (a, b) in short_leaks(whole, items).items()}
    if not len(items.keys):
        return [(k, *best[k]) for k in sorted(best)]
    overlap = int((items.sizes + 4 * items.edits).max()) + q
    for at in range(0, max(1, len(whole) - q + 1), SEGMENT):
        points = whole[at : at + SEGMENT + overlap]
        hashes = grams(points, q)
        where = np.flatnonzero(items.filter[(hashes >> np.uint64(64 - HASH_BITS)).astype(np.int64)])
        if not len(where):
            continue
        found = np.searchsorted(items.keys, hashes[where])
        real = (found < len(items.keys)) & (items.keys[np.minimum(found, len(items.keys) - 1)] == hashes[where])
        where, found = where[real], found[real]
        times = np.bincount(found, minlength=len(items.keys))
        shared = np.bincount(items.item[times[items.gram] > 0], minlength=len(items.ids))
        where, first = where[np.argsort(found, kind="stable")], np.cumsum(times) - times
        for k in np.flatnonzero(shared >= items.bounds).tolist():
            m, e = int(items.sizes[k]), int(items.edits[k])
            entries = items.entries[k][times[items.gram[items.entries[k]]] > 0]
            of = items.gram[entries]
            band, n = bands(where, first[of], times[of], items.place[entries], 2 * e + 1, m)
            band, n = band[n >= items.bounds[k]], n[n >= items.bounds[k]]
            for part, counts in zip(*(np.split(x, np.flatnonzero(np.diff(band) != 1) + 1) for x in (band, n)), strict=True) if len(band) else ():
                for group, most in [(part, counts.max())] if len(part) > FEW else [(part[i : i + 1], counts[i]) for i in range(len(part))]:
                    if k in best and best[k][0] <= max(0, -(-(m + 1 - int(most)) // q) - 1):  # the lemma: no fewer edits here
                        continue
                    low, high = (int(group[0]) - 1) * (2 * e + 1), (int(group[-1]) + 1) * (2 * e + 1) - 1
                    begin = max(0, low - e)
                    passage = points[begin : max(begin, high + m + e)]
                    distance, end = scan(items.points[k], passage) if len(group) > 1 or m > WIDE else align(items.points[k], passage, low - begin, high - begin)
                    if distance > e or (k in best and best[k][0] <= distance):
                        continue
                    back = align(items.points[k][::-1], passage[max(0, end - m - 2 * e) : end][::-1], -e, e, fixed=True)
                    start = max(0, end - back[1])
                    best[k] = distance, int(places[at + begin + start]), int(places[at + begin + end - 1]) + 1
    return [(k, *best[k]) for k in sorted(best)]


def _search(batches: Iterator[pa.RecordBatch], items: Broadcast) -> Iterator[pa.RecordBatch]:
    block: Items = items.value
    names = ["row", *(x.split()[0] for x in HITS.split(", "))]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        which, out = [], []
        for k, text in enumerate(batch.column("text").to_pylist()):
            for n, distance, start, end in leaks(text, block) if text else ():
                which.append(k)
                out.append((block.all_ids[n], distance, block.all_sizes[n], start, end))
        columns = zip(*out, strict=True) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(which, pa.int32())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=names)


def blocks(benchmark: DataFrame, item_column: str, text_column: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    rows = benchmark.select(benchmark[item_column].cast("long").alias("item"), benchmark[text_column].alias("text")).where("text IS NOT NULL")
    total = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = -(-total // block_chars)
    for k in range(n):
        yield [(r["item"], r["text"]) for r in rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).orderBy("item", "text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", q: int = Q, share: float = BUDGET, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """row (a struct of the other columns of docs), item_id, distance, item_chars, start, end: a row for each row of docs and item that it leaks."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns if c != text_column)).alias("row"), docs[text_column].alias("text"))
    schema = rows.select("row", *(F.lit(None).cast(x.split()[1]).alias(x.split()[0]) for x in HITS.split(", "))).schema
    found = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark, item_column, item_text_column, block_chars):
        items = docs.sparkSession.sparkContext.broadcast(Items(block, q, share, min_chars))
        found = found.unionByName(rows.mapInArrow(partial(_search, items=items), schema))
    return found


def _clean(batches: Iterator[pa.RecordBatch], items: Broadcast, text_column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        clean = [not (text and leaks(text, items.value)) for text in batch.column(text_column).to_pylist()]
        yield batch.filter(pa.array(clean, pa.bool_()))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text", q: int = Q, share: float = BUDGET, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs that leak no item. Rows are judged where they are, so nothing is shuffled."""
    bounded_batches(docs.sparkSession)
    for block in blocks(benchmark, item_column, item_text_column, block_chars):
        items = docs.sparkSession.sparkContext.broadcast(Items(block, q, share, min_chars))
        docs = docs.mapInArrow(partial(_clean, items=items, text_column=text_column), docs.schema)
    return docs


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("row.doc_id", "item_id", "distance", "item_chars", "start", "end")
