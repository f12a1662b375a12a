"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (seeded by its code point; white space between words counts as one letter). The vector of
an n-gram binds those of its letters, each rotated by its place, by multiplication; the profile of a text bundles (sums) those of its
n-grams. A language's prototype is the bundle of its training texts' profiles, each scaled to length 1, and a text gets the language
whose prototype has the largest cosine to its profile; what all prototypes have in common (their mean) is taken off them first.

Training uses at most per_language labelled texts for each language in expectation, chosen by a hash of the id among those offered;
languages with fewer give all. A prototype is a sum of fixed size for each task, so nothing that goes to the driver grows with the texts.

Defined results: a null text, or one without a letter, is `und` with score 0; ties go to the language first by name; without any training
row every text is `und`; null labels train nothing; rows that repeat train again; other columns are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm.common import bounded_batches, own_caches, shared_dir, unused, written

DIMENSIONS, N, SEED = 512, 3, 20240
PER_LANGUAGE = 10_000
MAX_LANGUAGES = 4096
#: n-grams whose vectors a worker keeps; beyond it starts anew.
CACHE_GRAMS = 30_000
#: Vectors that are made numbers of four bytes at a time.
ADDED = 4096
#: Code points of a text that are profiled at a time.
SEGMENT = 1 << 20
UND = "und"


@lru_cache(maxsize=20_000)
def letter(point: int, dimensions: int) -> np.ndarray:
    return np.random.default_rng((SEED, point)).integers(0, 2, dimensions, np.int8) * np.int8(2) - np.int8(1)


class Grams:
    """n-gram vectors as rows of a table, made when first seen."""

    def __init__(self, dimensions: int, n: int):
        self.dimensions, self.n, self.rows = dimensions, n, {}
        self.table = np.empty((1024, dimensions), np.int8)

    def vector(self, gram: tuple[int, ...]) -> np.ndarray:
        out = np.ones(self.dimensions, np.int8)
        for k, point in enumerate(gram):
            out *= np.roll(letter(point, self.dimensions), self.n - 1 - k)
        return out

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers for keys that pack n code points."""
        missing = [k for k in keys.tolist() if k not in self.rows]
        if len(self.rows) + len(missing) > CACHE_GRAMS:
            self.rows, missing = {}, keys.tolist()
        while len(self.table) < len(self.rows) + len(missing):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        for k in missing:
            self.table[len(self.rows)] = self.vector(tuple(k >> 21 * (self.n - 1 - i) & 0x1FFFFF for i in range(self.n)))
            self.rows[k] = len(self.rows)
        return np.fromiter(map(self.rows.__getitem__, keys.tolist()), np.int64, len(keys))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for code points that are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


_grams: dict[tuple[int, int], Grams] = {}


def profile(text: str | None, dimensions: int = DIMENSIONS, n: int = N) -> np.ndarray | None:
    """The bundle of a text's n-grams; None without a letter."""
    grams = _grams.setdefault((dimensions, n), Grams(dimensions, n))
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = _letters()[points]
    if not is_letter.any():
        return None
    points = np.where(is_letter, points, 32)
    points = np.r_[32, points, 32]
    points = points[np.r_[True, (points[1:] != 32) | (points[:-1] != 32)]]
    out = np.zeros(dimensions)
    for at in range(0, max(1, len(points) - n + 1), SEGMENT):
        part = points[at : at + SEGMENT + n - 1]
        keys = np.zeros(len(part) - n + 1, np.int64)
        for k in range(n):
            keys = keys << 21 | part[k : len(part) - n + 1 + k]
        keys, counts = np.unique(keys, return_counts=True)
        for k in range(0, len(keys), ADDED):
            rows = grams.of(keys[k : k + ADDED])
            out += counts[k : k + ADDED].astype(np.float32) @ grams.table[rows].astype(np.float32)
    return out


def _train(batches: Iterator[pa.RecordBatch], dimensions: int, n: int) -> Iterator[pa.RecordBatch]:
    own_caches("language", _grams.clear)
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            p = profile(text, dimensions, n)
            if p is not None and (size := np.linalg.norm(p)):
                sums[lang] = sums.get(lang, 0) + p / size
    for lang, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([lang] * dimensions), pa.array(range(dimensions), pa.int32()), pa.array(total)], names=["lang", "dim", "total"])


def train(docs: DataFrame, scratch: str, lang_column: str = "lang", text_column: str = "text", id_column: str = "doc_id", per_language: int = PER_LANGUAGE, dimensions: int = DIMENSIONS, n: int = N) -> dict[str, list[float]]:
    """The prototypes, from rows with a label."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(docs[text_column].alias("text"), docs[lang_column].alias("lang"), docs[id_column].alias("id")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels: {lang_column} does not hold languages")
    if not counts:
        return {}
    shares = {r["lang"]: min(1.0, per_language / r["count"]) for r in counts}
    share = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))[F.col("lang")]
    chosen = rows.where(F.pmod(F.xxhash64(F.col("id").cast("string"), "text"), F.lit(1 << 20)) < share * (1 << 20)).select("text", "lang")
    parts = chosen.mapInArrow(partial(_train, dimensions=dimensions, n=n), "lang string, dim int, total double")
    # sums of whole multiples, so that their order does not matter
    summed = parts.groupBy("lang", "dim").agg(F.sum(F.round(F.col("total") * (1 << 20)).cast("long")).alias("total"))
    table = written(summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "total"))).alias("v")), f"{scratch}/prototypes")
    return {r["lang"]: [float(x["total"]) for x in r["v"]] for r in sorted(table.collect(), key=lambda r: r["lang"])}


def _predict(batches: Iterator[pa.RecordBatch], prototypes: dict[str, list[float]], text_column: str, out: tuple[str, str], dimensions: int, n: int) -> Iterator[pa.RecordBatch]:
    own_caches("language", _grams.clear)
    names = sorted(prototypes)
    table = np.array([prototypes[k] for k in names]).reshape(len(names), dimensions)
    if len(names):
        table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-12)
    shared = table.mean(axis=0) if len(names) > 1 else np.zeros(dimensions)
    own = table - shared
    own /= np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12) if len(names) else 1
    for batch in batches:
        langs, scores = [], []
        for text in batch.column(text_column).to_pylist():
            p = profile(text, dimensions, n) if names else None
            if p is None:
                langs.append(UND)
                scores.append(0.0)
                continue
            cosines = own @ p / max(np.linalg.norm(p), 1e-12)
            best = int(np.argmax(cosines))
            langs.append(names[best])
            scores.append(float(min(1, max(0, cosines[best]))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *out])


def predict(docs: DataFrame, prototypes: dict[str, list[float]], text_column: str = "text", dimensions: int = DIMENSIONS, n: int = N) -> DataFrame:
    """docs with two more columns, the last: lang_pred, score (with underscores before them where docs has such columns)."""
    bounded_batches(docs.sparkSession)
    out = unused("lang_pred", docs), unused("score", docs)
    schema = docs.select("*", F.lit("").alias(out[0]), F.lit(0.0).alias(out[1])).schema
    return docs.mapInArrow(partial(_predict, prototypes=prototypes, text_column=text_column, out=out, dimensions=dimensions, n=n), schema)


def held_out(docs: DataFrame, id_column: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(docs[id_column].cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    prototypes = train(docs.where(~held_out(docs)), shared_dir(spark, "op2"))
    found = predict(docs.select("doc_id", held_out(docs).alias("held_out"), "text"), prototypes)
    return found.select("doc_id", "held_out", "lang_pred", "score")
