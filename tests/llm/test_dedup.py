"""Exact, line, substring and near duplicates against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brooklog.llm import ngram_join
from brooklog.llm.components import components
from brooklog.llm.exact_dedup import ExactDedup, op1_exact_dedup
from brooklog.llm.line_dedup import kept_lines, line_bitmaps, op9_line_dedup
from brooklog.llm.ngram_join import NgramJoin, op4_ngram_join
from brooklog.llm.substring_dedup import SubstringIndex, _bucket, bucket_of, cut, op6_substring_dedup

from . import brute
from .conftest import by_id

LONG = " ".join(f"w{k % 977}" for k in range(30_000))


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared, base = [text(20) for _ in range(3)], [text(rng.randint(60, 120)) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, LONG), (4, LONG + " end"), (5, "one"), (6, "ONE"), (7, "one two"), (8, "\x0bone\x0c two\r")]
    for d in range(9, n):
        kind = rng.random()
        words = text(rng.randint(1, 60)).split()
        if kind < 0.3:
            words = rng.choice(base).split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.6:
            at = rng.randrange(len(words))
            words[at:at] = rng.choice(shared).split()
        t = " ".join(words)
        if kind < 0.15:
            t = t.replace(" ", "\n", 2).upper() + "\n" + rng.choice(shared) + "  "
        rows.append((d, t))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_queries_equal_plain_versions(spark, tables, seed):
    rows = corpus(seed)
    at = tables.documents(rows, 3)
    got = by_id(op1_exact_dedup(spark, at))
    assert {d: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for d, r in got.items()} == brute.exact(rows)
    got = by_id(op9_line_dedup(spark, at))
    assert {d: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for d, r in got.items()} == brute.lines(rows)
    got = by_id(op6_substring_dedup(spark, at))
    assert {d: (r["n_words"], r["n_removed"], r["kept_sha256"]) for d, r in got.items()} == brute.substrings(rows)
    got = by_id(op4_ngram_join(spark, at))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == brute.near(rows, 3, 90)


QUERIES = [op1_exact_dedup, op4_ngram_join, op6_substring_dedup, op9_line_dedup]


@pytest.mark.parametrize("query", QUERIES)
def test_empty_table(spark, tables, query):
    assert query(spark, tables.documents([])).count() == 0


@pytest.mark.parametrize("query", QUERIES)
def test_null_ids_and_repeated_rows_give_a_row_each(spark, tables, query):
    text = " ".join(f"x{k}" for k in range(30))
    at = tables.documents([(None, text), (None, "other text here"), (7, text), (7, text), (8, text)])
    got = query(spark, at).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["7", "7", "8", "None", "None"]
    if query is op1_exact_dedup:
        assert sum(r["kept"] for r in got) == 2 and {r["keep_id"] for r in got if r["group_size"] == 4} == {7}
    if query is op6_substring_dedup:
        assert sorted((str(r["doc_id"]), r["n_removed"]) for r in got) == [("7", 0), ("7", 0), ("8", 30), ("None", 0), ("None", 30)]
    if query is op4_ngram_join:
        assert {(r["doc_id"], r["component_id"]) for r in got} == {(None, None), (7, 7), (8, 7)}


@pytest.mark.parametrize("name", ["line", "near", "substring"])
def test_extra_columns_may_have_any_name(spark, scratch, name):
    df = spark.createDataFrame([(k, "a line of some length", "x") for k in range(3)], "doc_id long, text string, other string")
    df = df.withColumns({c: F.lit(1) for c in ("id", "hash", "n", "c1", "c2", "text_key", "row", "keep", "pos", "component", "new", "shared")})
    if name == "line":
        assert line_bitmaps(df, scratch()).count() == 2
    elif name == "near":
        assert {r["component"] for r in NgramJoin(df, scratch()).result().collect()} == {0}
    else:
        hits = SubstringIndex(spark, scratch(), window=3, parts=4).add(df)
        assert sorted(r["n_removed"] for r in cut(df, hits, scratch(), 4, window=3).collect()) == [0, 5, 5]


def test_exact_state_continues_and_collisions_are_resolved(spark, tables, scratch):
    at = tables.documents([(k, f"text {k % 7}") for k in range(20)]) + "/documents.parquet"
    weak = ExactDedup(spark, scratch(), digest=lambda c: F.left(F.sha2(c.cast("binary"), 256), F.lit(1)))
    weak.update(at)
    want = {k: k % 7 for k in range(20)}
    assert {r["doc_id"]: r["keep_id"] for r in weak.result(at).collect()} == want
    spark.createDataFrame([(100, "text  6 ", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long").write.mode("append").parquet(at)
    again = ExactDedup(spark, weak.state, digest=weak.digest)
    again.update(at)
    got = {r["doc_id"]: r["keep_id"] for r in again.result(at, scratch()).collect()}
    assert got == want | {6: 100, 13: 100, 100: 100}  # the longer text stays


def test_line_bitmaps_say_which_lines_stay(spark, scratch):
    df = spark.createDataFrame([(1, "a repeated line\nown line here"), (2, "short\nA Repeated Line  \nshort")], "doc_id long, text string")
    (row,) = line_bitmaps(df, scratch()).collect()
    assert (row["id"], kept_lines(row["keep"], row["n_lines"]).tolist()) == (2, [True, False, True])


def test_a_line_in_many_documents_over_many_ranges(spark, scratch):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("the very common line\n"), F.col("id").cast("string")).alias("text")).repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        got = line_bitmaps(df, scratch()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
    assert sorted(r["id"] for r in got) == list(range(1, 400))


@pytest.mark.parametrize("bits", [64, 8])
def test_substring_index_over_batches(spark, scratch, bits):
    """With 8 bits most windows have a fingerprint that others have too, so hits are settled by their words."""
    rows = sorted((r for r in corpus(3, 80) if bits == 64 or r[0] not in (3, 4)), key=lambda r: r[0])
    passage = " ".join(f"q{k}" for k in range(16))
    rows += [(90, f"a {passage} b"), (91, f"{passage} {passage} {passage}"), (92, f"x {passage} {passage}")]  # in a row in 91, not in 90
    frame = lambda part: spark.createDataFrame(part, "doc_id long, text string")
    hits, state, root = None, None, scratch()
    for k in range(0, len(rows), 21):
        index = SubstringIndex(spark, root, max_runs=2, state=state, bits=bits)
        found = index.add(frame(rows[k : k + 21]))
        hits = found if hits is None else hits.unionByName(found)
        state = index.state()
        assert len(index.runs) <= 2
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in cut(frame(rows), hits, scratch(), index.parts, bits=bits).collect()}
    assert got == brute.substrings(rows)
    known = [r["fingerprint"] for r in spark.read.parquet(f"{root}/files").collect()]
    assert len(known) == len(set(known)) and index.batches == 4


def test_chain_of_near_copies_and_a_large_group(spark, scratch):
    rng = random.Random(4)
    base = [f"b{k}" for k in range(100)]
    rows = []
    for d in range(60):  # each differs from the one before in one word more
        rows.append((d, " ".join(base[: 100 - d // 2] + [f"z{k}" for k in range(d // 2)])))
    center = [f"c{k}" for k in range(120)]
    for d in range(100, 180):  # near copies of a text that is there too, at place 150
        copy = list(center)
        if d != 150:
            for _ in range(2):
                copy[rng.randrange(120)] = f"y{rng.randrange(10**6)}"
        rows.append((d, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for words, percent in ((3, 90), (5, 80)):
        got = {r["id"]: (r["n_shingles"], r["component"]) for r in NgramJoin(df, scratch(), words, percent).result().collect()}
        assert got == brute.near(rows, words, percent)


@pytest.mark.parametrize("seed", [2, 5])
def test_large_buckets_that_are_not_linked_to_their_leader(spark, scratch, seed):
    rng = random.Random(seed)
    phrase, rows = [f"p{k}" for k in range(12)], []
    for group in range(2):  # near copies; the phrase that some of both groups have is rarer than the words of a group, so it is in their prefixes
        base = [f"g{group}x{k}" for k in range(100)]
        for d in range(70):
            copy = list(base)
            copy[rng.randrange(100)] = f"y{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy + phrase * (d < 24))))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["id"]: (r["n_shingles"], r["component"]) for r in NgramJoin(df, scratch(), 3, 90).result().collect()} == brute.near(rows, 3, 90)


def linked(rows, k, percent):
    """All links between texts of different shingles, by the smallest ids that have them."""
    first = {}
    for d, t in sorted(rows):
        w = brute.words(brute.lower(t or ""))
        if w:
            first.setdefault(frozenset([tuple(w)]) if len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)), d)
    sets = sorted(first.items(), key=lambda x: x[1])
    return {(u, v) for n, (x, u) in enumerate(sets) for y, v in sets[n + 1 :] if 100 * (both := len(x & y)) >= percent * (len(x) + len(y) - both) and both}


def numbers_of_links(rows, k, percent):
    """Of each document: the other documents that link to it, copies among them."""
    sets = {}
    for d, t in rows:
        w = brute.words(brute.lower(t or ""))
        sets[d] = frozenset([tuple(w)]) if 0 < len(w) < k else frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else frozenset()
    return {d: sum(e != d and 100 * (both := len(x & y)) >= percent * (len(x) + len(y) - both) and both > 0 for e, y in sets.items()) for d, x in sets.items()}


@pytest.mark.parametrize("cell", [256, 7])
def test_pairs_are_all_links_between_classes(spark, scratch, monkeypatch, cell):
    monkeypatch.setattr("brooklog.llm.ngram_join.CELL", cell)
    rng = random.Random(7)
    center = [f"c{k}" for k in range(120)]
    rows = [r for r in corpus(2, 50) if r[0] not in (3, 4)]
    for d in range(100, 150):  # near copies that all link, in one component with the first
        copy = list(center)
        copy[rng.randrange(120)] = f"y{rng.randrange(10**6)}"
        rows.append((d, " ".join(copy)))
    for d in range(150, 190):  # others that share its words, few of them links
        copy = list(center)
        for _ in range(rng.randint(3, 8)):
            copy[rng.randrange(120)] = f"y{rng.randrange(10**6)}"
        rows.append((d, " ".join(copy)))
    rows.append((200, rows[-1][1]))
    df = spark.createDataFrame([*rows, (None, " ".join(center))], "doc_id long, text string").repartition(4)
    for words, percent in ((3, 90), (5, 80)):
        join = NgramJoin(df, scratch(), words, percent)
        found, want = [tuple(r) for r in join.pairs().collect()], linked(rows, words, percent)
        assert len(found) == len(set(found)) and set(found) == want and len(want) > 1000
        got = [r for r in join.result().collect() if r["id"] is not None]
        assert {r["id"]: r["component"] for r in got} == {d: c for d, (_, c) in brute.near(rows, words, percent).items()}
        assert {r["id"]: r["n_links"] for r in got} == numbers_of_links(rows, words, percent)


def test_rows_that_share_an_id_and_a_text_of_another_class(spark, scratch):
    text = [f"x{k}" for k in range(60)]
    rows = [(1, " ".join(text)), (1, " ".join(text)), (1, "something else"), (2, " ".join(text[:-1])), (3, " ".join(text[:-2]))]
    join = NgramJoin(spark.createDataFrame(rows, "doc_id long, text string"), scratch(), 3, 90)
    assert {tuple(r) for r in join.pairs().collect()} == {(1, 2), (1, 3), (2, 3)}
    got = sorted((r["id"], r["n_shingles"], r["component"], r["n_links"]) for r in join.result().collect())
    assert got == [(1, 1, 1, 2), (1, 58, 1, 3), (1, 58, 1, 3), (2, 57, 1, 3), (3, 56, 1, 3)]  # an id has the links of all its texts


def test_components(spark, scratch):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 200), (300, 100), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long"), scratch()).collect()}
    assert got == {k: 0 for k in range(41)} | {100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "u long, v long"), scratch()).count() == 0


def test_buckets_of_ids_are_the_same_in_tasks_and_in_columns(spark):
    ids = [0, 1, 7, -1, -12345678901, 2**62, 2**63 - 1, -(2**63), 10**15]
    got = spark.createDataFrame([(i,) for i in ids], "i long").select("i", bucket_of(F.col("i"), 51).alias("b")).collect()
    assert {r["i"]: r["b"] for r in got} == dict(zip(ids, _bucket(np.array(ids), 51).tolist(), strict=True))


def test_screen_keeps_all_texts_that_are_asked_for(spark, monkeypatch):
    texts = spark.range(-500, 500).selectExpr("id", "string(id) AS text")
    asked = spark.range(-500, 500, 7).toDF("id")
    for bits in (1 << 26, 1 << 15, 8):  # with 8 bits nearly all ids share one
        monkeypatch.setattr(ngram_join, "BITS", bits)
        kept = {r["id"] for r in ngram_join.NgramJoin._screened(texts, asked).collect()}
        assert kept >= set(range(-500, 500, 7))
    monkeypatch.setattr(ngram_join, "BITS", 1 << 26)
    assert len({r["id"] for r in ngram_join.NgramJoin._screened(texts, asked).collect()}) < 160
    assert ngram_join.NgramJoin._screened(texts, asked.limit(0)).count() == 0
