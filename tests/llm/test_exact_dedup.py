import hashlib
import random

import pytest

from cdrflow.llm import exact_dedup as X


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def rows():
    rnd = random.Random(4)
    texts = ["", None, "Éa", "éa", "ÉA", "a b", "A B", "x" * 50_000, "X" * 50_000, "\x00"] + [f"t{i}" for i in range(30)]
    out = [(i, rnd.choice(texts)) for i in range(200)] + [(500 + i, "HOT") for i in range(100)]
    return out + [(3, "same"), (3, "same"), (None, "same"), (None, "nobody"), (None, "Nobody")]


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_against_brute_force(spark, keep):
    data = rows()
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in data], "doc_id long, text string, kept int, content string").repartition(5)
    out = X.exact_duplicates(df, keep=keep).collect()
    groups = {}
    for i, t in data:
        groups.setdefault(lower(t), []).append(i)
    assert len(out) == len(data)
    kept = {}
    for r in out:
        g = next(v for k, v in groups.items() if hashlib.sha256(k.encode()).hexdigest() == r.text_sha256)
        ids = [i for i in g if i is not None]
        assert r.group_size == len(g)
        assert r.keep_id == ((min if keep == "smallest" else max)(ids) if ids else None)
        kept.setdefault(r.text_sha256, []).extend([r.doc_id] if r.kept else [])
        assert not r.kept or r.doc_id == r.keep_id
    assert len(kept) == len(groups) and all(len(v) == 1 for v in kept.values())


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_dropping_keeps_one_whole_row(spark, keep):
    data = rows()
    df = spark.createDataFrame([(i, t, 7, "z") for i, t in data], "doc_id long, text string, nr int, doc string").repartition(5)
    out = X.drop_duplicates(df, keep=keep)
    assert out.columns == df.columns
    groups = {}
    for i, t in data:
        groups.setdefault(lower(t), []).append(i)
    pick = min if keep == "smallest" else max
    expected = sorted((k, pick([i for i in v if i is not None], default=None)) for k, v in groups.items())
    assert sorted((lower(r.text), r.doc_id) for r in out.collect()) == expected
    assert X.drop_duplicates(df.limit(0), keep=keep).count() == 0


def test_a_hash_shared_by_different_texts_is_split(spark, monkeypatch):
    """Inside a group the bytes decide: texts that share the hash are groups of their own."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(X.F, "md5", lambda c: F.lit("00" * 16))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A"), (4, None), (5, "")], "doc_id long, text string")
    out = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in X.exact_duplicates(df).collect()}
    assert out == {1: (1, 2, True), 2: (2, 1, True), 3: (1, 2, False), 4: (4, 2, True), 5: (4, 2, False)}
    assert sorted(r.doc_id for r in X.drop_duplicates(df).collect()) == [1, 2, 4]
