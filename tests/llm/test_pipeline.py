"""The pipeline against a plain, single-process version of its stages."""

import duckdb
import public_tokenizers
import pytest
from conftest import SF001
from test_packing import check
from test_simhash import brute_components, brute_fingerprint
from tokenizers import Tokenizer

import corpus_pipeline as C
from cdrflow.llm import language as L
from cdrflow.llm.queries import ORACLES


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


@pytest.fixture(scope="module")
def expected(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    docs = {r[0]: r for r in con.execute("SELECT doc_id, text, lang FROM documents").fetchall()}
    verdict = con.execute(f"SELECT doc_id, kept FROM ({ORACLES['op3_adaptive_quality']})").fetchall()
    one = {i for i, kept in verdict if kept}
    model = L.fit(spark.createDataFrame([docs[i] for i in sorted(one)], "doc_id long, text string, lang string"))
    judge = L.Classifier(model)

    def accepted(text):
        lang, _, margin, short = judge(text)
        return lang != L.UNKNOWN and (short or margin > L.NARROW)

    two = {i for i in one if accepted(docs[i][1])}
    first = {}
    for i in sorted(two):
        first.setdefault(lower(docs[i][1]), i)
    three = set(first.values())
    prints = {i: brute_fingerprint(docs[i][1]) for i in three}
    root, head = brute_components(prints.values(), 4), {}
    for i in sorted(three):
        head.setdefault(root[prints[i]], i)
    return docs, [set(docs), one, two, three, set(head.values())]


def test_stages_and_result(spark, expected):
    docs, kept = expected
    frame = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = frame.columns
    for n, (name, stage) in enumerate(C.STAGES[:-1]):
        frame = C.materialize(stage(spark, frame, SF001), f"test-{name}")
        assert frame.columns == columns
        assert sorted(r.doc_id for r in frame.select("doc_id").collect()) == sorted(kept[n + 1])
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    check(C.run(spark, SF001).collect(), {i: docs[i][1] for i in kept[-1]}, tokenizer, 4096)


def test_odd_rows_pass_every_stage(spark):
    plain = "some words that make up a plain enough text of its own number {} to be kept by every stage here".format
    rows = [(i, plain(i), "en", "s", "c", 1) for i in range(12)]
    rows += [(None, None, None, None, None, None), (1, plain(1), "en", "s", "c", 1), (1, "", None, "s", None, 2), (None, "!" * 50, "en", None, "", 3)]
    rows += [(90, "word " + " ".join(f"w{n}" for n in range(30_000)), None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, failed string, rejected int")
    for empty in (False, True):
        frame = docs.limit(0) if empty else docs
        for name, stage in C.STAGES:
            frame = C.materialize(stage(spark, frame, ""), f"odd-{name}")
            if name != "packing":
                assert frame.columns == docs.columns
                assert empty == (frame.count() == 0)
    assert frame.count() == 0
