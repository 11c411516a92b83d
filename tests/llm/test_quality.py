import random
import re

import duckdb

from cdrflow.llm import quality as Q
from cdrflow.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    t = text or ""
    words = WORD.findall(t)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    at = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(at))


def texts():
    rnd = random.Random(1)
    vocabulary = ["a", "bb", "é#", "x|y", "\u00a0", "日本", "z\x1cq", "<p>"]
    made = [rnd.choice([" ", "\n", "\t "]).join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    return made + [None, "", " \n\x0b ", "w" * 9000, "a b c d e " * 400, "\n\n x\nx\n", "a b c d e", "a a a a a a", "é$" * 300]


def test_counts_against_brute_force(spark):
    data = [(i, t, 5, "k") for i, t in enumerate(texts())]
    df = spark.createDataFrame(data, "doc_id long, text string, n_words int, row string")
    out = {r.doc_id: tuple(r[c] for c in Q.COUNTS) for r in Q.with_counts(df, keep=["doc_id"]).collect()}
    assert out == {i: counts(t) for i, t, _, _ in data}


def test_fences_follow_the_group_and_keep_plain_documents(spark):
    rnd = random.Random(2)

    def doc(length, junk=""):
        return " ".join("".join(rnd.choice("abcdef") for _ in range(rnd.randint(length - 1, length + 1))) + junk for _ in range(80))

    rows = [(i, doc(5), "en", "s0") for i in range(300)] + [(1000 + i, doc(16), "de", "s1") for i in range(300)]
    rows += [(2000, doc(16), "en", "s0"), (2001, doc(5, "**"), "en", "s0"), (2002, doc(5), "de", "s1"), (2003, doc(5), None, None)]
    rows += [(2004, None, "en", None), (None, "", None, "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    featured = Q.with_counts(df, keep=["doc_id", "lang", "source"]).cache()
    out = {r.doc_id: r for r in Q.judge(featured).collect()}
    assert all(out[i].kept for i in [*range(300), *range(1000, 1300)])
    assert [out[i].failed for i in (2000, 2001, 2002)] == ["word_length", "symbol_rate", "word_length"]
    assert out[2003].kept and out[2004].base_failed and not out[None].kept and len(out) == len(rows)
    assert Q.judge(featured.limit(0)).count() == 0


def test_sketches_merge(spark):
    """The sketch of all rows is the sum of the sketches of parts."""
    rows = [(i, " ".join(["w" * (1 + i % 9)] * 3 + [str(j) for j in range(i % 40)]), "en", f"s{i % 3}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    f = Q.with_counts(df, keep=["lang", "source"]).cache()
    merged = Q.sketch(f, ["lang", "source"]).groupBy("lang", "metric", "bin").sum("n").collect()
    assert sorted(map(tuple, merged)) == sorted(map(tuple, Q.sketch(f, ["lang"]).collect()))


def test_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert "Python" not in Q.with_counts(df)._jdf.queryExecution().executedPlan().toString()


def test_a_source_with_much_junk_keeps_its_filter(spark):
    """A third of the hot source is symbol junk of many rates; the other sources are clean."""
    rnd = random.Random(3)

    def doc(symbols=0):
        words = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(3, 7))) for _ in range(80)]
        return " ".join(w + "#" * (symbols * (i + 1) // 80 - symbols * i // 80) for i, w in enumerate(words))

    for languages, others in ((["en", "de"], 4), (["en"], 1)):
        rows = [(f"c{lang}{s}{i}", doc(), lang, f"s{s}") for lang in languages for s in range(others) for i in range(220)]
        rows += [(f"ch{i}", doc(), "en", "hot") for i in range(400)] + [(f"j{i}", doc(12 + i), "en", "hot") for i in range(200)]
        df = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
        out = Q.judge(Q.with_counts(df, keep=["doc_id", "lang", "source"]).cache()).collect()
        assert all(r.failed == ("symbol_rate" if r.doc_id[0] == "j" else None) for r in out)
        assert len(out) == len(rows)


def test_the_oracle_has_the_bound_too(spark, tmp_path):
    """A table on which the bound decides: without it, no junk of the hot source would go."""
    rnd = random.Random(4)

    def doc(symbols=0):
        words = ["".join(rnd.choice("abcdef") for _ in range(rnd.randint(3, 7))) for _ in range(60)]
        return " ".join(w + "#" * (symbols * (i + 1) // 60 - symbols * i // 60) for i, w in enumerate(words))

    rows = [(1000 * s + i, doc(), "en", f"s{s}") for s in range(3) for i in range(210)]
    rows += [(5000 + i, doc(), "en", "hot") for i in range(300)] + [(6000 + i, doc(10 + i), "en", "hot") for i in range(150)]
    rows += [(7000, doc(), None, None), (7001, doc(40), None, None), (7002, None, "en", "hot"), (6000, doc(99), "en", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_adaptive_quality"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    out = [tuple(r) for r in got.collect()]
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op3_adaptive_quality']})").fetchall()
    assert sorted(map(repr, out)) == sorted(map(repr, want))
    assert sum(r[-1] == "symbol_rate" for r in out) == 152


def test_columns_of_any_name(spark):
    rows = [(i, "plain words of one text that go on for a while " * 8 + str(i), "en", "s", 7, "x", True, "l", None, "r") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, N_words int, failed string, Kept boolean,"
                                     " lim string, lim_lang string, row string")
    counted = Q.with_counts(df).cache()
    assert [c for c in counted.columns if c.lower() == "n_words"] == ["n_words"] and set(Q.COUNTS) < set(counted.columns)
    out = Q.judge(counted)
    assert sorted(out.columns) == sorted([*[c for c in counted.columns if c not in ("failed", "Kept")], "base_failed", "failed", "kept"])
    assert all(r.kept in (True, False) and r.lim == "l" and r.row == "r" and r.n_words > 10 for r in out.collect())
    assert out.count() == 5 and Q.judge(counted.limit(0)).count() == 0
