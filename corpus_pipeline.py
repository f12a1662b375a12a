"""Documents to packed sequences: language, repeated lines, near duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns rows with the columns of documents, but for
the last, which returns the pieces of packed sequences. What stages decide:

- language_id trains on the labels of its input and drops documents without a letter; a null lang gets the predicted one (`und` if
  there are no labels). No score is a reason to drop: that of a short clean text is of the size of the vectors' noise.
- line_dedup drops lines that a document of smaller id has; documents that lose lines and have only white space left go.
- near_duplicates (five-word shingles, similarity 0.8) keeps one row of each component, that of the smallest id (null counts as the
  largest); rows are judged one by one, whether or not their ids repeat.
- decontamination drops documents with a passage within the edit budget of a benchmark item.
- packing cuts and places the ids of every document that is left.

Defined results: a null or empty text, or one without a letter, goes in the first stage; in the others it would stay (line_dedup drops a
text only if it lost lines) and is packed as the end id. Null ids count as the largest in line_dedup and near_duplicates, and come back
as null. Rows that repeat are each judged: one of them stays in near_duplicates, the first by id and then by row number. Ties go to the
smallest id. Long texts are processed whole. Empty tables give empty ones. Other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklog.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from brooklog.llm.common import WHITE, remove, shared_dir, written

NUMBER = "__row_number"
#: The tokenizers and the trained profiles are outside SQL.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prototypes = language_id.train(docs, shared_dir(spark, "language"))
    judged = language_id.predict(docs, prototypes)
    predicted = F.col(judged.columns[-2])
    # texts with a letter are `und` too where nothing is trained, or where that is a label
    judged = judged.where((predicted != language_id.UND) | F.col("text").rlike(r"\p{L}"))
    return judged.select(*(F.coalesce("lang", predicted).alias("lang") if c == "lang" else c for c in docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = line_dedup.with_kept_text(docs, shared_dir(spark, "lines"))
    changed = F.col(kept.columns[-1]).isNotNull()
    kept = kept.where(~changed | (F.btrim("text", F.lit(WHITE)) != ""))
    return kept.select(*(F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c == "n_chars" else c for c in docs.columns))


def numbered(docs: DataFrame, path: str) -> DataFrame:
    """With a number for each row, the same whenever it is read: by its place in a file (two files' rows share one with a chance of 2^-64), else written."""
    if docs._jdf.queryExecution().analyzed().nodeName().startswith("LogicalRelation"):
        return docs.select("*", F.xxhash64("_metadata.file_path", "_metadata.row_index").alias(NUMBER))
    return written(docs.withColumn(NUMBER, F.monotonically_increasing_id()), path)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scratch = shared_dir(spark, "near")
    rows = numbered(docs, f"{scratch}/numbered")
    found = ngram_join.NgramJoin(rows, scratch, id_column=NUMBER).result().select("id", "component")
    found = written(found.join(rows.select(F.col(NUMBER).alias("id"), "doc_id"), "id"), f"{scratch}/members")
    # one number a component, so that nothing is joined by component, which a large group would fill
    stay = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")).alias("first")).select("first.id")
    gone = found.join(stay, "id", "left_anti").select(F.col("id").alias(NUMBER))
    return rows.join(gone, NUMBER, "left_anti").select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), shared_dir(spark, "pipeline"), None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{scratch}/{k}-{name}"
        docs = written(stage(spark, docs, sf_dir), path)
        if old:
            remove(spark, old)
        old = path
    return docs
