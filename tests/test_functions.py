"""Column functions: one test per decision of SURVEY §1.4, plus models."""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdrflow.functions import cleaning as C
from cdrflow.functions import csvtext as X
from cdrflow.mapping import OCC_MAPPING


def col_of(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.select(fn(F.col("v")).alias("o"), "i").orderBy("i").collect()]


# ---- numbers (D7, D8, D9) -------------------------------------------------
def test_safe_number_guard(spark):
    vals = ["+5", "-2.5", " 5", ".5", "5.", "1e3", "", "123\r", "1.5", "-12.5", None]
    out = col_of(spark, vals, lambda c: C.safe_number(c, 30, 0))
    assert out == [Decimal(5), Decimal(-3), None, None, None, None, None, None, Decimal(2), Decimal(-13), None]


def test_overflow_flag(spark):
    big = "1" * 25
    out = col_of(spark, [big, "123.45", "x"], lambda c: C.overflows(c, 20, 5))
    assert out == [True, False, False]
    assert col_of(spark, [big], lambda c: C.safe_number(c, 20, 5)) == [None]


def py_safe_number(s, p, sc):
    if s is None or not re.fullmatch(r"[+-]?[0-9]+(\.[0-9]+)?", s):
        return None
    d = Decimal(s).quantize(Decimal(1).scaleb(-sc), rounding=ROUND_HALF_UP)
    if len(d.as_tuple().digits) > p and abs(d) >= Decimal(10) ** (p - sc):
        return None
    return d


number_text = st.one_of(
    st.from_regex(r"\A[+-]?[0-9]{1,22}(\.[0-9]{1,8})?\Z"),
    st.text(alphabet="0123456789.+-e \t", max_size=12),
)


@settings(max_examples=4, deadline=None)
@given(st.lists(number_text, min_size=50, max_size=200))
def test_safe_number_model(spark, vals):
    for p, sc in ((30, 0), (20, 5)):
        out = col_of(spark, vals, lambda c: C.safe_number(c, p, sc))
        exp = [py_safe_number(v, p, sc) for v in vals]
        assert out == exp


# ---- strings (T1-T4, T8, T9, D18, D19) ------------------------------------
def test_clean_msisdn_keeps_plus(spark):
    assert col_of(spark, ["\t+216 123\r\n"], C.clean_msisdn) == ["+216123"]


def test_clean_string_cut_default_blank(spark):
    apn = next(s for s in OCC_MAPPING if s.source == "APN")
    kw = next(s for s in OCC_MAPPING if s.source == "KEYWORD")
    bm = next(s for s in OCC_MAPPING if s.source == "B_MSISDN")
    assert col_of(spark, ["x" * 60], lambda c: C.clean_string(c, apn)) == ["x" * 50]
    assert col_of(spark, ["", None, "  ", " kw1 "], lambda c: C.clean_string(c, kw)) == ["_N", "_N", "_N", "kw1"]
    assert col_of(spark, ["", "\t"], lambda c: C.clean_string(c, bm)) == [None, None]


def test_dedup_key_fallback_and_cut(spark):
    df = spark.createDataFrame([(" ", " CR1 ", "R1"), ("X" * 41, None, None), (None, "", "")], "a string, b string, c string")
    out = [r[0] for r in df.select(C.dedup_key(["a", "b", "c"], 40)).collect()]
    assert out == ["CR1", "X" * 40, None]


# ---- time (D5, D6, T13) ---------------------------------------------------
def test_epoch_seconds_zone_free(spark):
    vals = ["0", "1609459199", "1609459200", "1" * 23, " 1609459200", "253402300799", "253402300800"]
    for tz in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        out = col_of(spark, vals, lambda c: C.epoch_to_ntz(c, "seconds"))
        hours = col_of(spark, vals, lambda c: C.start_hour(C.epoch_to_ntz(c, "seconds")))
        assert [str(x) if x else None for x in out] == [
            "1970-01-01 00:00:00", "2020-12-31 23:59:59", "2021-01-01 00:00:00", None, None,
            "9999-12-31 23:59:59", None,
        ]
        assert hours[:3] == [0, 23, 0]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")


def test_epoch_millis_rounds_half_up(spark):
    out = col_of(spark, ["1609459199499", "1609459199500", "0"], lambda c: C.epoch_to_ntz(c, "milliseconds"))
    assert [str(x) for x in out] == ["2020-12-31 23:59:59", "2021-01-01 00:00:00", "1970-01-01 00:00:00"]


# ---- headers (S7) ---------------------------------------------------------
def sanitize(spark, names):
    df = spark.createDataFrame([(names,)], "h array<string>")
    return list(df.select(X.sanitize_columns(F.col("h"))).first()[0])


def test_sanitize_edges(spark):
    assert sanitize(spark, ["A", "A_01", "A"]) == ["A", "A_01", "A_02"]
    assert sanitize(spark, [""]) == ["C_"]
    assert sanitize(spark, ["1x"]) == ["C_1X"]
    assert sanitize(spark, ["ß"]) == ["C_"]
    long = "abcdefghijklmnopqrstuvwxyz12345"
    assert sanitize(spark, [long + "X", long + "Y"]) == ["ABCDEFGHIJKLMNOPQRSTUVWXYZ1234", "ABCDEFGHIJKLMNOPQRSTUVWXYZ1_01"]
    assert sanitize(spark, [" a-msisdn ", "A MSISDN"]) == ["A_MSISDN", "A_MSISDN_01"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.sampled_from(["a", "A", "a_01", " a ", "1", "", "ß", "x-y", "X_Y", "z" * 35, "é"]), min_size=1, max_size=14))
def test_sanitize_properties(spark, names):
    """Unique storage names; each is its base, or the base with the lowest suffix that was free."""
    out = sanitize(spark, names)
    assert len(set(out)) == len(out)
    assert all(len(x) <= 30 and re.fullmatch(r"[A-Z][A-Z0-9_]*", x) for x in out)
    for k, (name, got) in enumerate(zip(names, out)):
        base = sanitize(spark, [name])[0]
        if base not in out[:k]:
            assert got == base
        else:
            number = int(re.search(r"_(\d\d+)$", got)[1])
            lower = [base[: 30 - len(f"_{n:02d}")] + f"_{n:02d}" for n in range(1, number + 1)]
            assert got == lower[-1] and set(lower[:-1]) <= set(out[:k])


def test_sanitize_wide_headers_quickly(spark):
    import time

    names = [f"col {i}" for i in range(3000)]
    sanitize(spark, names[:3])
    start = time.perf_counter()
    assert sanitize(spark, names)[-1] == "COL_2999"
    assert time.perf_counter() - start < 5
    assert sanitize(spark, ["same"] * 400)[-1] == "SAME_399"


# ---- CSV fields (S4, S5, D13) ---------------------------------------------
def encode(fields):
    out = []
    for f in fields:
        if any(ch in f for ch in ',"') or f[:1] in (" ", "\t"):
            out.append('"' + f.replace('"', '""') + '"')
        else:
            out.append(f)
    return ",".join(out)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.text(alphabet='ab ,"\t{}:', max_size=6), min_size=1, max_size=6), min_size=20, max_size=40))
def test_split_and_count_model(spark, rows):
    lines = [encode(r) for r in rows]
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, l string")
    got = df.select("i", X.split_fields(F.col("l")).alias("f"), X.odd_quotes(F.col("l")).alias("odd")).orderBy("i").collect()
    for r, fields in zip(got, rows):
        assert list(r["f"]) == fields
        assert r["odd"] is False


def test_quote_parity_and_count(spark):
    lines = ['"a","b"', '"a","b"x"', 'a,b,', 'a,"b,c",d', '']
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, l string")
    r = df.select(X.odd_quotes(F.col("l")), F.size(X.split_fields(F.col("l")))).collect()
    assert [x[0] for x in r] == [False, True, False, False, False]
    assert [x[1] for x in r] == [2, 2, 3, 3, 1]


def test_odd_quoting(spark):
    """Blanks before a quote are skipped, text after it stays, a quote inside a bare field is a character."""
    cases = {
        'OCC, "x,y",P1': ["OCC", "x,y", "P1"],
        '"ab"cd,e': ["abcd", "e"],
        'a"b,c"': ['a"b', 'c"'],
        '"a""b",""': ['a"b', ""],
        '\t"x" y, z ': ["x y", " z "],
        '"",,"""q"""': ["", "", '"q"'],
        '"a"b"c",d': ['ab"c"', "d"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "l string")
    assert {r[0]: list(r[1]) for r in df.select("l", X.split_fields(F.col("l"))).collect()} == cases


# ---- whitelist modes (S8, D16, D17) ----------------------------------------
def test_whitelist_modes(spark):
    from cdrflow.sources.csv_ingest import validate_columns

    mapping_keys = [s.source for s in OCC_MAPPING]
    typical = ["AGGREGATION_GROUP", "A_IMSI", "A_MSISDN_ORIG", "APN", "CALL_TYPE", "CHARGING_ID",
               "DATASOURCE", "EVENT_TYPE", "ORIG_START_TIME"]
    staging = mapping_keys + ["AGGREGATION_GROUP", "A_IMSI", "A_MSISDN_ORIG"]
    df = spark.createDataFrame([(typical,), (["DATASOURCE", "A_MSISDN", "UNKNOWN_FIELD_1", "INVALID_COL"],),
                                (["DATASOURCE", "A_MSISDN", "SOURCE_FILE", "SOURCE_DIR", "LOAD_TS"],)], "h array<string>")

    def run(mode, allowed):
        return [list(r[0]) for r in df.select(validate_columns(F.col("h"), allowed, mode, mapping_keys)).collect()]

    assert run("dynamic", staging) == [[], ["UNKNOWN_FIELD_1", "INVALID_COL"], []]
    assert run("strict", staging) == [["AGGREGATION_GROUP", "A_IMSI", "A_MSISDN_ORIG"], ["UNKNOWN_FIELD_1", "INVALID_COL"], []]
    assert run("permissive", staging) == [[], [], []]
    assert run("dynamic", []) == [[], [], []]  # empty staging layout -> accept all


def test_table_volume(spark, tmp_path):
    from cdrflow.plans.monitor import table_volume

    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    r = table_volume(spark.read.parquet(path)).first()
    files = [f for f in __import__("os").listdir(path) if f.endswith(".parquet")]
    assert r.FILES == len(files) == 3
    assert r.BYTES == sum(__import__("os").path.getsize(f"{path}/{f}") for f in files)
