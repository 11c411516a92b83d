import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cdrflow.llm import byte_bpe as B

TEXTS = [None, "", " ", "a" * 4000, "it's we'll DON'T 12345 ½ x\u3000y z\x85w\u00a0q", "日本語テキスト 🎉🎉 مرحبا बहुत", "Āā ĀāĀ \x01a\x021\x01",
         "=-" * 500, " \x1c x\x0b\t\n\n  end", "the the the of of and", "é" * 300 + "\u0301" * 3, "<|endoftext|>", "x\r\ny  \n"]


@pytest.fixture(scope="module")
def vocabulary():
    return B.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=vocabulary.pieces, special_tokens={})


@pytest.mark.parametrize("cached", [0, 3, 1000])
def test_equals_the_library_whatever_is_cached(spark, vocabulary, reference, cached):
    data = [(i, t, 1) for i, t in enumerate(TEXTS * 2)]
    df = spark.createDataFrame(data, "doc_id long, text string, word int")
    out = B.encode(df, vocabulary, most_cached=cached).select(
        "text", "ids", B.decode(F.col("ids"), vocabulary).alias("back"), F.sha2(B.packed(F.col("ids"), vocabulary), 256).alias("h")
    )
    rows = out.collect()
    assert len(rows) == len(data)
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        assert list(r.ids) == ids
        assert bytes(r.back) == (r.text or "").encode()
        assert r.h == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_no_documents(spark, vocabulary):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.encode(df, vocabulary).collect() == []


def test_columns_of_any_name(spark, vocabulary, reference):
    rows = [(1, "the cat the cat", "a", 3, None), (1, "the cat the cat", "a", 3, None), (None, None, "b", None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, word int, n int")
    out = B.encode(df, vocabulary).collect()
    assert [tuple(r)[:2] for r in out] == [r[:2] for r in rows] and [r.word for r in out] == [3, 3, None]
    assert [list(r.ids) for r in out] == [reference.encode_ordinary(r[1] or "") for r in rows]


def test_the_cache_is_bounded_in_bytes(spark, vocabulary, reference, monkeypatch):
    """Long words and words beyond the bytes are folded where they stand, with the same ids."""
    texts = ["x" * 300 + " ab" * 9 + " cde" * 5, "x" * 300 + " fgh" * 3 + " ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert not any("x" * 300 in t for t in B.cached_words(df, "text", vocabulary).texts)
    monkeypatch.setattr(B, "MAX_CACHED_BYTES", 8)
    cache = "".join(B.cached_words(df, "text", vocabulary).texts)
    assert " ab" in cache and " cde" in cache and " fgh" not in cache
    assert [list(r.ids) for r in B.encode(df, vocabulary).orderBy("doc_id").collect()] == [reference.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize("short", [0, 64, 5000])
def test_both_folds_equal_the_library(spark, vocabulary, reference, monkeypatch, short):
    monkeypatch.setattr(B, "SHORT", short)
    words = [" ", "a", "ab" * 30, "aaaaaaa", "-=" * 20, " Straßenbahnen", "日本語テ", "x" * 65, "qzxjkvbw" * 8, "antidisestablish"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    tables = [vocabulary.ranks(spark), vocabulary.pairs(spark)]
    rows = B.with_tables(df, tables, "ids", lambda r, p: B.fold(F.col("word"), vocabulary, r, p)).collect()
    assert [list(r.ids) for r in rows] == [reference._core_bpe.encode_single_piece(w.encode()) for w in words]


def test_tables_are_neither_in_the_plan_nor_in_the_rows(spark, vocabulary):
    """The frequent words' ids and the ranks are values of subqueries, read in the one projection over the documents."""
    df = spark.createDataFrame([(1, "a word and a word " * 3)], "doc_id long, text string")
    plan = B.encode(df, vocabulary)._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 100_000 and plan.count("Project [") == 1


def test_the_cache_holds_no_more_words_than_asked_for(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(B, "COUNT_LIMIT", 3)
    df = spark.createDataFrame([(1, "a" + " b" * 9)], "doc_id long, text string")
    assert B.cached_words(df, "text", vocabulary, 0).texts == [""]
