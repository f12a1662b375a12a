"""Packing, archives and the pipeline."""

from __future__ import annotations

import gzip
import io
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brooklog.llm import packing, warc

from . import brute
from .conftest import by_id

TEXTS = [None, "", "Hello, World.", "don't stop... it's 3.14, ok?", "ÉTÉ İstanbul ΣΑΣ ﬁn", "<|endoftext|> <|ENDOFTEXT|>", "a" * 9000, "tab\tand\x0bfeed\x0c\x1cend x y", "x, y. z., .a ,b", "word " * 5000, "日本語 テキスト", "é ́x"]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_words_give_the_ids_of_the_whole_text(tokenizer, monkeypatch):
    import public_tokenizers

    encode = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    for limit, segment in ((10**6, 10**6), (50, 40)):
        monkeypatch.setattr(packing, "CACHE_WORDS", limit)
        monkeypatch.setattr(packing, "SEGMENT", segment)
        for text in TEXTS[1:]:
            assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:40]


def test_packing_is_a_round_trip_without_padding(spark, tables, tokenizer):
    rng = random.Random(1)
    rows = list(enumerate(TEXTS + [" ".join(rng.choice("the of and house river blue".split()) for _ in range(rng.randint(0, 3000))) for _ in range(60)]))
    pieces = packing.op5_packing(spark, tables.documents(rows, 3)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for d, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(by_doc[d], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            at += p["length"]
            assert zlib.crc32(ids[p["start"] : at].tobytes()) == p["ids_crc32"]
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 2048 and at & (at - 1) == 0
    assert sum(sum(p["length"] for p in h) < 2048 for h in by_sequence.values()) <= 11 * 3


def test_full_sequences_hold_a_fixed_number_of_one_class():
    packer, ids = packing.Packer(16, 0), lambda n: bytes(4 * n)
    out = [x for k in range(10) for x in packer.add(k, ids(4))]
    assert [(p[0], s, o) for p, s, o in out] == [(k, k // 4, 4 * (k % 4)) for k in range(8)]
    assert [(p[0], s, o) for p, s, o in packer.close()] == [(8, 2, 0), (9, 2, 4)]
    packer = packing.Packer(16, 0)
    assert packer.add("a", ids(7)) == []
    assert packer.add("b", ids(7)) == []  # closes class 2 with space 2
    out = packer.add("c", ids(5))  # fills it, and is a filler from then on
    assert [(p[0], p[2], len(p[3]) // 4, s, o) for p, s, o in out] == [("a", 0, 7, 0, 0), ("b", 0, 7, 0, 7), ("c", 0, 2, 0, 14)]
    assert [(p[0], p[2], len(p[3]) // 4, s, o) for p, s, o in packer.close()] == [("c", 2, 2, 1, 0), ("c", 4, 1, 2, 0)]


@pytest.mark.parametrize("capacity", [8, 64, 2048])
def test_no_plain_packer_needs_fewer_sequences_and_short_documents_stay_whole(capacity):
    rng, packer = random.Random(capacity), packing.Packer(capacity, 0)
    sizes = [max(1, int(rng.lognormvariate(np.log(capacity / 3), 1))) for _ in range(3000)]
    out = [x for d, n in enumerate(sizes) for x in packer.add(d, np.arange(n, dtype="<u4").tobytes())] + packer.close()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for (d, total, start, ids), sequence, offset in out:
        assert total == sizes[d] and np.frombuffer(ids, "<u4").tolist() == list(range(start, start + len(ids) // 4))
        by_doc[d].append((start, len(ids) // 4))
        by_sequence[sequence].append((offset, len(ids) // 4))
    for d, n in enumerate(sizes):
        assert sum(size for _, size in by_doc[d]) == n
    used = [sum(size for _, size in v) for v in by_sequence.values()]
    assert all(u & (u - 1) == 0 and u <= capacity for u in used) and sum(u < capacity for u in used) <= capacity.bit_length()
    best = -(-sum(sizes) // capacity)  # of any packer, if documents may be cut
    assert len(used) <= best + capacity.bit_length()
    short = [d for d, n in enumerate(sizes) if n <= capacity]
    assert sum(len(by_doc[d]) > 1 for d in short) < 0.1 * len(short) and len(out) < 1.7 * len(sizes)


def test_any_tokenizer_gives_its_own_ids():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, whole = packing.encoder(path), Tokenizer.from_file(path)
    for text in TEXTS[1:]:
        assert np.frombuffer(encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert isinstance(packing.encoder(public_tokenizers.path("word_bpe_49k.json")), packing.WordEncoder)


def test_packing_of_null_ids_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "a b", 1), (None, "a b", 2), (7, "c", 3), (7, "c", 3)], "doc_id long, text string, start long")
    df = df.withColumns({c: F.lit("x") for c in ("length", "sequence_id", "offset", "ids_crc32", "row")})
    got = packing.pack(df).collect()
    assert sorted(str(r["doc_id"]) for r in got if r["start"] == 0) == ["7", "7", "None", "None"]
    assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)


def test_packing_of_nothing_and_of_odd_capacity(spark, tables):
    assert packing.op5_packing(spark, tables.documents([])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, "a")], "doc_id long, text string"), capacity=100)


def pages(spark, tables, rows):
    return tables.table("pages", rows, "page_id long, url string, html string")


def test_archives_round_trip(spark, tables):
    big, small = "<p>" + "é" * 60, "x" * 99
    rows = [(3, "http://a/1", big), (1, "http://a/2", big), (2, None, big), (4, "http://a/ 4\n", small), (5, "u", small), (6, "u", None), (7, "u", ""), (8, "u", "y" * 300_000), (9, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    got = {r["page_id"]: r for r in warc.op10_warc(spark, pages(spark, tables, rows)).collect()}
    assert len(got) == len(rows)
    for d, _, html in rows:
        data = (html or "").encode()
        assert (got[d]["payload_bytes"], got[d]["payload_digest"]) == (len(data), brute.sha(html or ""))
        assert (got[d]["record_type"], got[d]["refers_to"]) == (("revisit", 1) if d in (2, 3) else ("response", None))


def test_archives_of_nothing_and_of_null_ids(spark, tables, tmp_path):
    assert warc.op10_warc(spark, pages(spark, tables, [])).count() == 0
    tables.root = tmp_path / "more"
    got = warc.op10_warc(spark, pages(spark, tables, [(None, "u", "z" * 200), (5, "u", "z" * 200), (5, "u", "z" * 200)])).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got) == [("5", "response", None), ("5", "response", None), ("None", "revisit", 5)]


def test_normaliser_makes_members_that_stand_alone():
    records = [warc.record(k, f"http://h/{k}", b"p" * k, "d", None) for k in (0, 10, 3_000_000)]
    for source in (gzip.compress(b"".join(records)), b"".join(gzip.compress(r) for r in records)):  # one stream, and already in members
        target = io.BytesIO()
        places = list(warc.normalise(io.BytesIO(source), target))
        data = target.getvalue()
        assert [gzip.decompress(data[p["offset"] : p["offset"] + p["length"]]) for p in places] == records
        assert sum(p["length"] for p in places) == len(data) and places[1]["uri"] == "http://h/10"
    with pytest.raises((ValueError, EOFError)):
        list(warc.normalise(io.BytesIO(gzip.compress(records[1][:-20])), io.BytesIO()))


def test_many_archives(spark, tables, scratch):
    df = spark.range(2000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string").cast("binary"), 512).alias("html"))
    at = scratch()
    manifest = warc.write_archives(warc.revisits(df, at), f"{at}/m", archive_bytes=2000)
    assert manifest.count() > 4
    back = warc.read_archives(warc.normalise_archives(manifest, f"{at}/m", f"{at}/n"), f"{at}/n")
    assert sorted(r["record_id"] for r in back.collect()) == sorted(f"<urn:x-page:{k}>" for k in range(2000))


def test_pipeline_stages(spark, tables):
    rng = random.Random(3)
    words = "the river house of blue stone and green hill over water under sky while birds sing".split()
    some = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) * (rng.random() < 0.3) for _ in range(n))
    item = "which of the rivers in the northern valley has the greatest length of all"
    clean = [(d, some(80), "en") for d in range(12)]
    long = some(100)
    rows = clean + [(20, long, "en"), (21, long + " more", "en"), (30, some(30) + " " + item.upper(), "en"), (40, "123 456", "en"), (41, None, "en")]
    rows += [(50, "a common first line\n" + some(60), None), (51, "a common first line\n" + some(60), "en"), (52, "a common first line", "en")]
    at = tables.documents(rows)
    tables.table("benchmark", [(1, item)], "item_id long, text string")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    left, names = docs, [name for name, _ in corpus_pipeline.STAGES]
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, at)
        assert left.schema.simpleString() == docs.schema.simpleString(), name
        kept.append({r["doc_id"] for r in left.collect()})
    everything = {r[0] for r in rows}
    assert kept[0] == everything - {40, 41}
    assert kept[1] == kept[0] - {52}
    assert kept[2] == kept[1] - {21}
    assert kept[3] == kept[2] - {30}
    found = by_id(left)
    assert found[50]["lang"] == "en" and found[51]["text"] == rows[-2][1].split("\n")[1] and found[51]["n_chars"] == len(found[51]["text"])
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, at).collect()} == kept[3]
    assert names == ["language_id", "line_dedup", "near_duplicates", "decontamination", "packing"]


def test_language_stage_keeps_short_clean_texts(spark, tables, tmp_path):
    rng = random.Random(5)
    words = {"en": "the river house of blue stone and green hill over water".split(), "fr": "le fleuve maison de pierre bleue et colline verte sur eau".split()}
    rows = [(d, " ".join(rng.choice(words[lang]) for _ in range(40)), lang) for d, lang in enumerate(["en", "fr"] * 10)]
    short = ["Avec.", "A.", "Ok", "Quiz", "Why?", "Zut!", "Yes", "Non", "Ja", "Hm", "x", "Été", "日本", "Да"]
    rows += [(100 + k, t, lang) for k, t in enumerate(short) for lang in ("en", "fr", None, "und")]
    rows += [(900, "12.", "en"), (901, None, "fr"), (902, "", None), (903, "?!", "und")]
    stage = lambda rows: corpus_pipeline.identify_language(spark, spark.read.parquet(tables.documents(rows) + "/documents.parquet"), "").collect()
    got = stage(rows)
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted(r[:2] for r in rows if r[0] < 900)
    assert all(r["lang"] for r in got)
    tables.root = tmp_path / "unlabelled"
    assert {(r["doc_id"], r["lang"]) for r in stage([(1, "some text", None), (2, "12", None)])} == {(1, "und")}


@pytest.mark.parametrize("lazy", [False, True])
def test_near_duplicates_with_repeated_and_null_ids(spark, tables, lazy):
    text = lambda name: " ".join(f"{name}{k}" for k in range(60))
    a, b, c, d, e = map(text, "abcde")
    rows = [(5, a), (5, a), (None, b), (None, b), (None, b + " more"), (6, c), (6, d), (7, c + " more"), (8, e), (8, a + " more"), (None, a), (None, ""), (None, ""), (9, None)]
    docs = spark.read.parquet(tables.documents(rows, 3) + "/documents.parquet")
    got = corpus_pipeline.drop_near_duplicates(spark, docs.where("true").limit(100) if lazy else docs, "").collect()
    key = lambda rows: sorted(((str(r[0]), str(r[1])[:3]) for r in rows))
    assert key(got) == key([(5, a), (None, b), (6, c), (6, d), (8, e), (None, ""), (None, ""), (9, None)])


def test_pipeline_of_nothing(spark, tables):
    at = tables.documents([])
    tables.table("benchmark", [], "item_id long, text string")
    assert corpus_pipeline.run(spark, at).count() == 0
