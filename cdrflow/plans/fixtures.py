"""Synthetic CDR inputs derived, row for row, from the driver tables.

* ``cdr_raw``        OCC staging rows (all text) built from ``events``;
* ``detail_existing`` keys already loaded before the batch (from ``events``);
* ``load_audit``     the per-file audit log built from ``orders``;
* ``staging_mmg``    MMG staging rows built from ``documents``.

Every rule is a plain column expression, so the frames scale with the source
tables and the same rules are written as SQL in ``plans.oracle_sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.functions.cleaning import ntz
from cdrflow.mapping import OCC_MAPPING

# Fixed clock of every time-window query (never the wall clock).
AS_OF = "2024-01-31 00:00:00"
TODAY = "2024-01-30"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> Column:
    return c.cast(T.StringType())


def _pad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


def event_source(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """(event_id, ts, user_id, event_type, value, props) rows to build CDRs from.

    ``events`` as is; ``lineitem`` (six times more rows) mapped onto the same
    columns for a heavier load with the same recipe.
    """
    if source == "events":
        return _table(spark, sf_dir, "events")
    if source == "lineitem":
        li = _table(spark, sf_dir, "lineitem")
        return li.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
            F.col("l_shipdate").alias("ts"),
            F.col("l_suppkey").alias("user_id"),
            F.concat("l_returnflag", "l_linestatus").alias("event_type"),
            F.col("l_extendedprice").alias("value"),
            F.concat(F.lit('{"q": '), F.col("l_quantity").cast("int").cast("string"), F.lit("}")).alias("props"),
        )
    raise ValueError(f"unknown source {source!r}")


def cdr_raw(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """OCC staging (text columns + SOURCE_FILE, SOURCE_DIR, LOAD_TS, SOURCE_LINE)."""
    ev = event_source(spark, sf_dir, source)
    e = F.col("event_id")
    u = _pad(F.col("user_id"), 8)
    ep = _s(F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))

    def m(n):
        return e % F.lit(n)

    apn = F.when(m(3) == 0, "internet").when(m(3) == 1, "mms").otherwise(" wap ")
    charging = (
        F.when(m(89) == 0, F.lit("   "))
        .when(m(100) == 51, F.concat(F.lit(" CH"), _s(e - 21), F.lit(" ")))
        .when(m(10) == 1, F.concat(F.lit(" CH"), _s(e - 1), F.lit(" ")))
        .otherwise(F.concat(F.lit("CH"), _s(e)))
    )
    return ev.select(
        F.concat(F.lit("CDR_OCC_"), _pad(m(20), 2), F.lit(".csv")).alias("SOURCE_FILE"),
        F.lit("OCC").alias("SOURCE_DIR"),
        F.col("ts").alias("LOAD_TS"),
        e.alias("SOURCE_LINE"),
        F.lit(" OCC ").alias("DATASOURCE"),
        F.when(m(31) == 0, F.lit("12"))
        .when(m(37) == 0, F.concat(F.lit("\t+216 "), u))
        .otherwise(F.concat(F.lit("216"), u))
        .alias("A_MSISDN"),
        F.when(m(5) == 0, F.lit(""))
        .otherwise(F.concat(F.lit("216 "), _pad((F.col("user_id") * 7) % 100000, 8)))
        .alias("B_MSISDN"),
        F.when(m(97) == 0, F.lit("N/A"))
        .when(m(101) == 0, F.concat(F.lit(" "), ep))
        .otherwise(ep)
        .alias("ORIG_START_TIME"),
        apn.alias("APN"),
        F.when(m(2) == 0, F.lit(" data ")).otherwise(F.lit("sms")).alias("CALL_TYPE"),
        F.col("event_type").alias("EVENT_TYPE"),
        charging.alias("CHARGING_ID"),
        F.concat(F.lit("SVC"), _s(m(13))).alias("SERVICE_ID"),
        F.when(m(2) == 0, F.lit("PREPAID")).otherwise(F.lit("POSTPAID")).alias("SUBSCRIBER_TYPE"),
        F.when(m(3) == 0, F.lit("ROAM")).otherwise(F.lit("HOME")).alias("ROAMING_TYPE"),
        F.concat(F.lit("P"), _s(m(9))).alias("PARTNER"),
        F.when(m(113) == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("F"), _s(m(4))))
        .alias("FILTER_CODE"),
        F.lit("x").alias("FLEX_FLD1"),
        F.lit("y").alias("FLEX_FLD2"),
        F.col("props").alias("FLEX_FLD3"),
        F.when(m(43) == 0, F.lit("1.5")).otherwise(_s(F.lit(1) + m(3))).alias("EVENT_COUNT"),
        F.when(m(41) == 0, F.lit("1e3"))
        .when(m(47) == 0, F.lit(" 5"))
        .otherwise(_s(F.col("value").cast(T.DecimalType(30, 5))))
        .alias("DATA_VOLUME"),
        _s((e * 17) % 3600).alias("EVENT_DURATION"),
        F.concat(
            F.when(m(53) == 0, F.lit("-")).otherwise(F.lit("")),
            _s(F.col("value").cast(T.DecimalType(20, 5))),
        ).alias("CHARGE_AMOUNT"),
        F.when(m(2) == 1, F.lit("")).otherwise(F.lit("0.25")).alias("DA_AMOUNT_CALC"),
        F.when(m(59) == 0, F.lit(".5")).otherwise(F.lit("+1.00000")).alias("MA_AMNT_CALC"),
        F.when(m(4) == 0, F.lit(""))
        .when(m(4) == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" kw"), _s(m(6))))
        .alias("KEYWORD"),
        F.concat(F.lit("CR"), _s(e)).alias("CALL_REFERENCE"),
        F.concat(F.lit("R"), _s(e)).alias("RECORD_ID"),
    )


def detail_existing(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Narrow key table of rows loaded before the batch: CH<e> for e % 7 = 0."""
    ev = event_source(spark, sf_dir, source)
    return ev.where(F.col("event_id") % 7 == 0).select(
        F.concat(F.lit("CH"), _s(F.col("event_id"))).alias("CHARGING_ID")
    )


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LOAD_AUDIT rows (one current row per file) built from ``orders``."""
    o = _table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    src = F.when(k % 3 == 0, F.lit("MMG")).otherwise(F.lit("OCC"))
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("SUCCESS"))
        .when(F.col("o_orderstatus") == "P", F.lit("ERROR"))
        .otherwise(F.lit("DOWNLOADED"))
    )
    n = F.when(c % 25 == 0, F.lit(0)).otherwise(F.lit(100) + k % 900)
    r = F.when(c % 25 == 0, F.lit(0)).otherwise(c % 50)
    err = (
        F.when(k % 4 == 0, F.lit("CSV_INVALID: Empty file"))
        .when(k % 4 == 1, F.lit("WHITELIST_ERROR: Unknown columns: X"))
        .when(k % 4 == 2, F.lit("LOAD_ERROR: Wrong column count at data line 7 got=3 expected=25"))
        .otherwise(F.lit("TRANSFORM_ERROR: duplicate key"))
    )
    ok = F.col("o_orderstatus") == "F"
    message = (
        F.when(ok, F.format_string("TMP:%d DETAIL:%d REJECTED:%d", n, n - r, r))
        .when(F.col("o_orderstatus") == "P", err)
        .otherwise(F.lit(None).cast("string"))
    )
    rows = F.when(ok, n.cast("bigint"))
    return o.select(
        src.alias("SOURCE_DIR"),
        F.concat(F.lit("CDR_"), src, F.lit("_"), _s(k), F.lit(".csv")).alias("FILE_NAME"),
        (F.lit(1000) + c).cast("bigint").alias("FILE_SIZE"),
        status.alias("STATUS"),
        F.timestamp_add("MINUTE", -((k * 29) % 43200), ntz(AS_OF)).alias("LOAD_TS"),
        message.alias("MESSAGE"),
        rows.alias("ROWS_CSV"),
        rows.alias("ROWS_DB"),
    )


def staging_mmg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MMG staging rows (text) built from ``documents``."""
    d = _table(spark, sf_dir, "documents")
    return d.select(
        _s(F.col("doc_id")).alias("DOC_ID"),
        F.col("lang").alias("LANG"),
        F.col("source").alias("SOURCE"),
        F.concat(F.lit("CDR_MMG_"), _s(F.col("doc_id") % 5), F.lit(".csv")).alias("SOURCE_FILE"),
        F.lit("MMG").alias("SOURCE_DIR"),
        F.timestamp_add("MINUTE", -F.col("doc_id"), ntz(AS_OF)).alias("LOAD_TS"),
    )


# ---------------------------------------------------------------------------
# CSV lines built from cdr_raw (strict-ingest fixture)
# ---------------------------------------------------------------------------
# Broken or special files, by construction:
#   03 first data row lacks its last field      -> LOAD_ERROR (count, line 2)
#   05 5th data row has one extra quote          -> LOAD_ERROR (quotes, line 6)
#   07 CRLF endings, a blank line every 10 rows  -> passes
#   09 header names UNKNOWN_FIELD_1              -> WHITELIST_ERROR
#   13 lone CR inside FLEX_FLD1                  -> passes, CR kept in the value
#   15 columns in reverse order                  -> passes
#   17 no KEYWORD, CALL_REFERENCE, RECORD_ID     -> passes, those NULL
CSV_COLUMNS = [spec.source for spec in OCC_MAPPING]
DROPPED_17 = ("KEYWORD", "CALL_REFERENCE", "RECORD_ID")


def file_columns(file_no: int) -> list[str]:
    if file_no == 15:
        return list(reversed(CSV_COLUMNS))
    if file_no == 17:
        return [c for c in CSV_COLUMNS if c not in DROPPED_17]
    return list(CSV_COLUMNS)


def _quoted(c: Column) -> Column:
    return F.when(c.isNull(), F.lit("")).otherwise(
        F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    )


def _physical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Physical lines (SOURCE_DIR, FILE_NAME, n, t) of the 20 OCC files, CR and blank lines as they are."""
    raw = cdr_raw(spark, sf_dir).withColumn("FILE_NO", (F.col("SOURCE_LINE") % 20).cast("int"))
    raw = raw.withColumn(
        "FLEX_FLD1",
        F.when(F.col("FILE_NO") == 13, F.concat(F.col("FLEX_FLD1"), F.lit("\ry"))).otherwise(F.col("FLEX_FLD1")),
    )
    # quote every field once; the line variants below only join them
    raw = raw.select("SOURCE_DIR", "SOURCE_FILE", "SOURCE_LINE", "FILE_NO",
                     *[_quoted(F.col(c)).alias(f"Q_{c}") for c in CSV_COLUMNS])
    r = F.floor(F.col("SOURCE_LINE") / 20).cast("bigint") + 1  # data row rank in its file

    def joined(cols):
        return F.concat_ws(",", *[F.col(f"Q_{c}") for c in cols])

    line = (
        F.when(F.col("FILE_NO") == 15, joined(file_columns(15)))
        .when(F.col("FILE_NO") == 17, joined(file_columns(17)))
        .when((F.col("FILE_NO") == 3) & (r == 1), joined(CSV_COLUMNS[:-1]))
        .when((F.col("FILE_NO") == 5) & (r == 5), F.concat(joined(CSV_COLUMNS), F.lit('"')))
        .otherwise(joined(CSV_COLUMNS))
    )
    line = F.when(F.col("FILE_NO") == 7, F.concat(line, F.lit("\r"))).otherwise(line)
    line_no = F.when(F.col("FILE_NO") == 7, F.lit(1) + r + F.floor((r - 1) / 10)).otherwise(F.lit(1) + r)
    entries = F.when(
        (F.col("FILE_NO") == 7) & (r % 10 == 0),
        F.array(F.struct(line_no.alias("n"), line.alias("t")), F.struct((line_no + 1).alias("n"), F.lit("\r").alias("t"))),
    ).otherwise(F.array(F.struct(line_no.alias("n"), line.alias("t"))))
    data = raw.select("SOURCE_DIR", F.col("SOURCE_FILE").alias("FILE_NAME"), F.inline(entries))

    return _header_rows(raw).unionByName(data)


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered lines (SOURCE_DIR, FILE_NAME, LINE_NO, LINE) as the line scan gives them."""
    from cdrflow.functions.csvtext import strip_eol

    return _physical_lines(spark, sf_dir).select(
        "SOURCE_DIR", "FILE_NAME", F.col("n").cast("bigint").alias("LINE_NO"), strip_eol(F.col("t")).alias("LINE")
    )


def csv_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files as a scan reads them, before any numbering: file, split, row id and raw text.

    Splits of a file hold 97 lines each; row ids grow by one inside a split, from a
    start that says nothing about its place in the file.
    """
    n = F.col("n").cast("bigint")
    block = F.call_function("div", n - 1, F.lit(97))
    return _physical_lines(spark, sf_dir).select(
        "SOURCE_DIR",
        "FILE_NAME",
        F.concat(F.lit("file:/landing/"), "FILE_NAME").alias("FILE_PATH"),
        (block * 4096).alias("BLOCK"),
        (F.pmod(F.xxhash64("FILE_NAME", block), F.lit(1 << 40)) + n).alias("ROW_ID"),
        F.col("t").alias("RAW"),
    )


def _header(no: int) -> str:
    cols = file_columns(no)
    if no == 9:
        cols = ["UNKNOWN_FIELD_1" if c == "FLEX_FLD2" else c for c in cols]
    return ",".join(cols)


def _header_rows(raw: DataFrame) -> DataFrame:
    files = raw.groupBy("SOURCE_DIR", "SOURCE_FILE", "FILE_NO").agg(F.count(F.lit(1)).alias("_n"))
    hdr = F.lit(_header(0))
    for no in (7, 9, 15, 17):
        text = _header(no) + ("\r" if no == 7 else "")
        hdr = F.when(F.col("FILE_NO") == no, F.lit(text)).otherwise(hdr)
    return files.select("SOURCE_DIR", F.col("SOURCE_FILE").alias("FILE_NAME"),
                        F.lit(1).cast("bigint").alias("n"), hdr.alias("t"))


def csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header line of each file of ``csv_lines`` (what the split scan yields)."""
    from cdrflow.functions.csvtext import strip_eol

    raw = cdr_raw(spark, sf_dir).select("SOURCE_DIR", "SOURCE_FILE", (F.col("SOURCE_LINE") % 20).cast("int").alias("FILE_NO"))
    return _header_rows(raw).select("SOURCE_DIR", "FILE_NAME", strip_eol(F.col("t")).alias("HEADER_LINE"))
