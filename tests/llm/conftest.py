from __future__ import annotations

import uuid

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


class Tables:
    """Writes tables into a folder that a query can be run over."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def documents(self, rows, files=2):
        """rows: (doc_id, text) or (doc_id, text, lang)."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        self.spark.createDataFrame(full, SCHEMA).repartition(files).write.parquet(f"{self.root}/documents.parquet")
        return str(self.root)

    def table(self, name, rows, schema):
        self.spark.createDataFrame(rows, schema).write.parquet(f"{self.root}/{name}.parquet")
        return str(self.root)


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, tmp_path)


@pytest.fixture
def scratch(tmp_path):
    return lambda: str(tmp_path / uuid.uuid4().hex)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
