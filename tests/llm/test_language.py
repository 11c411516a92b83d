import random
import zlib

import pytest
from conftest import SF01

from cdrflow.llm import language as L
from cdrflow.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    rows = QUERIES["op10_zstd_language"](spark, SF01).collect()
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    out = [r for r in rows if r.held_out]
    assert sum(docs[r.doc_id].lang == r.lang_pred for r in out) > 0.97 * len(out)
    assert sum(r.rejected for r in rows) < 0.005 * len(rows)


def test_edge_cases(spark):
    df = spark.createDataFrame([(1, "alpha beta " * 30, "aa"), (2, "gamma delta " * 30, "bb"), (3, None, "aa"), (4, "7 8", "bb"), (5, "x", None)],
                               "doc_id long, text string, lang string")
    model = L.fit(df)
    assert set(model) == {"aa", "bb"}
    cases = [(1, None), (2, ""), (3, "12 .. \u0301"), (4, "alpha beta"), (5, "delta gamma " * 40_000), (5, "q"), (None, "gamma"),
             (6, "alpha beta gamma delta " * 0 + "zq xj vk " * 40)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in cases], "doc_id long, text string, other int")
    out = L.identify(docs, model).collect()
    assert [r.lang_pred for r in out[:5]] == ["und", "und", "und", "aa", "bb"]
    assert [r.rejected for r in out] == [True, True, True, False, False, False, False, True]
    assert all(r.score == 0 for r in out[:3])
    assert L.identify(docs.limit(0), model).count() == 0
    assert {r.lang_pred for r in L.identify(docs, L.fit(df.limit(0))).collect()} == {"und"}


def test_label_source_and_id_do_not_matter(spark):
    a = L.Classifier({"aa": b"alpha beta ", "bb": b"gamma delta "})
    assert a("Alpha, beta!") == a("alpha beta")
    assert L.letters("É-té 12 \u00df") == "é té \u00df" and L.letters("\u0301 1") == ""


def test_the_sample_is_bounded(spark):
    df = spark.range(500).selectExpr("id as doc_id", "repeat('hello world ', 500) as text", "'aa' as lang")
    model = L.fit(df, sample_docs=5, dict_bytes=3000)
    assert len(model["aa"]) <= 3001


@pytest.fixture(scope="module")
def corpus(spark):
    """The model of sf0.01, and the letters of all texts of a language."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    texts = {}
    for r in docs.orderBy("doc_id").collect():
        texts.setdefault(r.lang, []).append(L.letters(r.text))
    return L.fit(docs), texts


def long_text(texts, n):
    joined = " ".join(texts)
    return (joined * (1 + n // len(joined)))[:n]


def test_every_part_of_a_long_text_counts(corpus):
    """A head in another language does not decide."""
    model, texts = corpus
    judge = L.Classifier(model)
    for head, tail in ((50_000, 500_000), (130_000, 1_500_000)):
        assert judge(long_text(texts["de"], head) + " " + long_text(texts["en"], tail))[0] == "en"
        assert judge(long_text(texts["en"], head) + " " + long_text(texts["de"], tail))[0] == "de"


def test_clean_long_texts_stay(spark, corpus):
    """The margin of a clean text does not fall with its length."""
    model, texts = corpus
    rows = [(n, lang, long_text(texts[lang], n)) for lang in ("en", "de", "es") for n in (20_000, 1_000_000, 4_000_000)]
    docs = spark.createDataFrame(rows, "n long, lang string, text string")
    out = {(r.lang, r.n): r for r in L.identify(docs, model).drop("text").collect()}
    assert all(r.lang_pred == lang and not r.rejected for (lang, _), r in out.items())
    assert all(out[lang, n].margin > 0.7 * out[lang, 20_000].margin for lang, n in out)


def test_mixed_and_unlearned_languages_go_and_clean_texts_stay(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").collect()
    learnt = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    clean = [r for r in docs if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and len(L.letters(r.text)) >= 100]

    def judged(without, texts):
        judge = L.Classifier(L.fit(spark.createDataFrame([r for r in learnt if r.lang != without], "doc_id long, text string, lang string")))
        found = [judge(t) for t in texts]
        return sum(not short and margin <= L.NARROW for _, _, margin, short in found) / len(found)

    assert judged(None, [r.text for r in clean]) < 0.01
    rnd = random.Random(5)
    for n in (100, 400, 1000):
        mixed = []
        while len(mixed) < 100:
            a, b = rnd.choice(clean), rnd.choice(clean)
            if a.lang != b.lang:
                a, b = long_text([L.letters(a.text)], n // 2), long_text([L.letters(b.text)], n // 2)
                mixed.append(a + " " + b)
        assert judged(None, mixed) > 0.4
        assert judged(None, ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)) for _ in range(50)]) > 0.95
    for lang in ("de", "en", "es", "fr"):
        assert judged(lang, [r.text for r in clean if r.lang == lang]) > 0.8
    assert judged(None, ["zqx vkw xqz jjq kzx wqk zxv qqj xzk vvq"]) == 1


def test_columns_of_any_name(spark):
    model = {"aa": b"alpha beta " * 20, "bb": b"gamma delta " * 20}
    rows = [(1, "alpha beta", 0.5, "x", None, 9), (1, "alpha beta", 0.5, "x", None, 9), (None, None, None, None, True, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Score double, lang_pred string, rejected boolean, names int")
    out = L.identify(df, model)
    assert out.columns == ["doc_id", "text", "names", "lang_pred", "score", "margin", "rejected"]
    assert [(r.doc_id, r.names, r.lang_pred) for r in out.collect()] == [(1, 9, "aa"), (1, 9, "aa"), (None, None, "und")]
    # the text itself may stand in such a column
    named = spark.createDataFrame([(1, "gamma delta")], "doc_id long, lang_pred string")
    assert [tuple(r)[:2] for r in L.identify(named, model, text_col="lang_pred").collect()] == [(1, "bb")]
    assert L.identify(df.limit(0), model).count() == 0


def test_the_sample_is_the_smallest_hashes(spark):
    """The cut by the hash's length loses nothing, though one language and one id have most rows."""
    spelt = lambda i: "w" + str(i).translate(str.maketrans("0123456789", "abcdefghij"))
    rows = [(i, spelt(i), "aa") for i in range(3000)] + [(5000 + i, spelt(i), "bb") for i in range(4)]
    rows += [(None, "none", "cc")] * 50 + [(7, "same", "aa")] * 2000 + [(1, None, "aa"), (2, "x", None), (3, "12", "dd")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    model = L.fit(df, sample_docs=10)
    assert set(model) == {"aa", "bb", "cc"}
    hashes = {r.h: r.i for r in spark.range(3000).selectExpr("id as i", "xxhash64(cast(id as string), 10) as h").collect()}
    smallest = [hashes[h] for h in sorted(hashes)[:10]]
    assert 7 not in smallest
    # two of ten (the fifth and the tenth) are left out of the dictionary
    assert set(model["aa"].decode().split()) == {spelt(i) for nr, i in enumerate(smallest, 1) if nr % L.LEAVE_OUT}
    assert set(model["bb"].decode().split()) == {spelt(i) for i in range(4)}


def test_any_part_of_a_text_may_be_sampled(spark):
    """The sampled part does not always begin at the text's first character."""
    rows = [(i, "opening " * 400 + "closing " * 400, "aa") for i in range(20)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert b"opening" in model["aa"] and b"closing" in model["aa"]


def test_decisions_by_brute_force(spark, corpus):
    """Each text packed anew with every dictionary, chunk by chunk, without anything that the operator prepares."""
    import zstandard as zstd

    model, _ = corpus
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(150)

    def size(data, name):
        n = -(-len(data) // 2000) or 1
        step = -(-len(data) // n) or 1
        packer = zstd.ZstdCompressor(level=12, write_content_size=False, dict_data=zstd.ZstdCompressionDict(model[name], dict_type=zstd.DICT_TYPE_RAWCONTENT))
        return sum(len(packer.compress(data[i : i + step])) for i in range(0, len(data), step))

    clear = 0
    for r in L.identify(docs, model).collect():
        data = L.letters(r.text).encode()
        if not data:
            assert r.lang_pred == "und"
            continue
        sizes = sorted((size(data, name), name) for name in model)
        if sizes[1][0] - sizes[0][0] > 2 + len(data) // 500:
            clear += 1
            assert r.lang_pred == sizes[0][1]
    assert clear > 100
