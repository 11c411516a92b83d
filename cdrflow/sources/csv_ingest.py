"""Strict CSV ingest over a numbered-lines frame.

Input: one row per physical line, ``(SOURCE_DIR, FILE_NAME, LINE_NO, LINE)``
with LINE_NO starting at 1 (the header) and trailing CR/LF already removed;
``sources.landing.scan_lines`` produces it from files, the fixtures from the
driver tables.  Output: per-file header info, per-file outcome (first failing
check wins) and the all-text staging rows of the files that passed.

Every file's header carries the place of each staging column as an array, so
one parse plan of fixed size serves any number of layouts, and nothing about
the files reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.functions import csvtext as X
from cdrflow.mapping import TECHNICAL_COLUMNS
from cdrflow.operators.audit import error_message

FILE = ["SOURCE_DIR", "FILE_NAME"]


@dataclass(frozen=True)
class CsvDialect:
    delimiter: str = ","
    quote: str = '"'


def file_headers(lines: DataFrame) -> DataFrame:
    """Header line (line 1) of every file."""
    return lines.where(F.col("LINE_NO") == 1).select(*FILE, F.col("LINE").alias("HEADER_LINE"))


def validate_columns(names: Column, allowed: list[str] | None, mode: str = "dynamic",
                     mapping_keys: list[str] | None = None) -> Column:
    """Names not in the whitelist (technical columns always allowed).

    * ``dynamic``: whitelist = staging columns; an empty list accepts all;
    * ``permissive``: accepts all;
    * ``strict``: whitelist = the mapping's source columns.
    Repeated unknown names are reported each time.
    """
    if mode == "permissive":
        return F.array().cast("array<string>")
    allow = list(mapping_keys or []) if mode == "strict" else list(allowed or [])
    if mode == "dynamic" and not allow:
        return F.array().cast("array<string>")
    allow_arr = F.array(*[F.lit(a) for a in list(allow) + list(TECHNICAL_COLUMNS)])
    return F.filter(names, lambda x: ~F.array_contains(allow_arr, x))


def header_info(
    headers: DataFrame,
    allowed: list[str] | None,
    mode: str = "dynamic",
    mapping_keys: list[str] | None = None,
    dialect: CsvDialect = CsvDialect(),
    validate: str = "raw",
) -> DataFrame:
    """Per file: raw and sanitized header names, count, whitelist result (lazy)."""
    raw = X.split_fields(F.col("HEADER_LINE"), dialect.delimiter, dialect.quote)
    info = headers.withColumn("HEADER_RAW", raw).withColumn("N_COLS", F.size("HEADER_RAW").cast("int"))
    storage = X.sanitize_columns(F.col("HEADER_RAW"))
    if validate == "raw":  # only headers that pass the whitelist are turned into storage names
        info = info.withColumn("UNKNOWN_COLUMNS", validate_columns(F.col("HEADER_RAW"), allowed, mode, mapping_keys))
        rejected = F.size("UNKNOWN_COLUMNS") > 0
        info = info.withColumn("HEADER_COLS", F.when(rejected, F.array().cast("array<string>")).otherwise(storage))
    else:
        info = info.withColumn("HEADER_COLS", storage)
        info = info.withColumn("UNKNOWN_COLUMNS", validate_columns(F.col("HEADER_COLS"), allowed, mode, mapping_keys))
    bad_store = (
        F.filter("HEADER_COLS", lambda x: ~F.array_contains(F.array(*[F.lit(a) for a in allowed]), x))
        if allowed
        else F.array().cast("array<string>")
    )
    return info.withColumn("NOT_IN_STAGING", bad_store)


def layouts(info: DataFrame) -> list[list[str]]:
    """Distinct sanitized header layouts of the accepted files, for reports.

    One small aggregate over file metadata: bounded by the number of distinct
    accepted headers, not by the data, and not by what rejected files hold.
    """
    accepted = info.where((F.size("UNKNOWN_COLUMNS") == 0) & (F.size("NOT_IN_STAGING") == 0))
    r = accepted.agg(F.collect_set("HEADER_COLS").alias("L")).first()
    return sorted([list(x) for x in (r["L"] or [])])


def positions(header: Column, staging_columns: list[str]) -> Column:
    """Place of each staging column in a header, from 0; -1 for one that it does not have."""
    return F.transform(
        F.array(*[F.lit(c) for c in staging_columns]), lambda c: (F.array_position(header, c) - 1).cast("int")
    )


def parse_lines(
    lines: DataFrame,
    info: DataFrame,
    staging_columns: list[str],
    dialect: CsvDialect = CsvDialect(),
) -> DataFrame:
    """Data lines of every file: per-line error (if any) and staging values.

    Blank lines are skipped (still counted in LINE_NO).  Checks, in order:
    odd number of enclosures, then field count vs the header's.  Lines of
    rejected files are only counted.
    """
    accepted = (F.size("UNKNOWN_COLUMNS") == 0) & (F.size("NOT_IN_STAGING") == 0)
    # a file without places is a rejected one
    small = info.select(
        *FILE, "N_COLS", F.when(accepted, positions(F.col("HEADER_COLS"), staging_columns)).alias("_AT")
    )
    data = lines.where((F.col("LINE_NO") > 1) & (F.col("LINE") != "")).join(small, FILE, "inner")

    # values and count come from one split of the line, done once
    fields = F.when(F.col("_AT").isNotNull(), X.split_fields(F.col("LINE"), dialect.delimiter, dialect.quote))
    parsed = data.select(
        *FILE, "LINE_NO", "N_COLS", "_AT", X.odd_quotes(F.col("LINE"), dialect.quote).alias("_ODD"), fields.alias("_F")
    )
    got = F.size("_F")
    err = F.when(
        F.col("_AT").isNotNull(),
        F.when(F.col("_ODD"), F.format_string("Broken line (unbalanced quotes) at data line %d", F.col("LINE_NO")))
        .when(got != F.col("N_COLS"),
              F.format_string("Wrong column count at data line %d got=%d expected=%d",
                              F.col("LINE_NO"), got, F.col("N_COLS"))),
    )
    values = [F.nullif(F.get("_F", F.get("_AT", F.lit(i))), F.lit("")).alias(c) for i, c in enumerate(staging_columns)]
    return parsed.select(*FILE, "LINE_NO", err.alias("LINE_ERROR"), *values)


def file_routing(info: DataFrame, parsed: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """Outcome per file; the first failing check wins.

    CSV_INVALID (no header line) -> WHITELIST_ERROR -> LOAD_ERROR (columns not
    in staging, then the first bad data line).  ROWS_CSV counts data lines.
    """
    per_file = parsed.groupBy(*FILE).agg(
        F.count(F.lit(1)).alias("ROWS_CSV"),
        F.min(F.when(F.col("LINE_ERROR").isNotNull(), F.struct("LINE_NO", "LINE_ERROR"))).alias("_BAD"),
    )
    files = info.select(*FILE, "UNKNOWN_COLUMNS", "NOT_IN_STAGING").withColumn("_HDR", F.lit(True))
    if listing is not None:
        files = listing.select(*FILE).join(files, FILE, "left")
    out = files.join(per_file, FILE, "left")
    csv_invalid = F.when(F.col("_HDR").isNull(), F.lit("Empty file"))
    whitelist = F.when(F.size("UNKNOWN_COLUMNS") > 0,
                       F.concat(F.lit("Unknown columns: "), F.array_join("UNKNOWN_COLUMNS", ", ")))
    load = F.coalesce(
        F.when(F.size("NOT_IN_STAGING") > 0,
               F.concat(F.lit("Unknown staging columns: "), F.array_join("NOT_IN_STAGING", ", "))),
        F.col("_BAD.LINE_ERROR"),
    )
    first = F.coalesce(
        F.when(csv_invalid.isNotNull(), F.struct(F.lit("CSV_INVALID").alias("c"), csv_invalid.alias("d"))),
        F.when(whitelist.isNotNull(), F.struct(F.lit("WHITELIST_ERROR").alias("c"), whitelist.alias("d"))),
        F.when(load.isNotNull(), F.struct(F.lit("LOAD_ERROR").alias("c"), load.alias("d"))),
    )
    return out.select(
        *FILE,
        F.when(first.isNull(), F.lit("SUCCESS")).otherwise(F.lit("ERROR")).alias("STATUS"),
        first.getField("c").alias("ERROR_CLASS"),
        F.when(first.isNotNull(), error_message(first.getField("c"), first.getField("d"))).alias("MESSAGE"),
        F.col("_BAD.LINE_NO").alias("FIRST_BAD_LINE"),
        F.coalesce(F.col("ROWS_CSV"), F.lit(0)).cast("bigint").alias("ROWS_CSV"),
    )


def staging_rows(parsed: DataFrame, routing: DataFrame, staging_columns: list[str],
                 load_ts: Column) -> DataFrame:
    """All-text staging rows of the files that passed, with technical columns."""
    ok = routing.where(F.col("STATUS") == "SUCCESS").select(*FILE)
    return parsed.join(ok, FILE, "left_semi").select(
        *staging_columns,
        F.col("FILE_NAME").alias("SOURCE_FILE"),
        "SOURCE_DIR",
        load_ts.cast(T.TimestampNTZType()).alias("LOAD_TS"),
        F.col("LINE_NO").cast("bigint").alias("SOURCE_LINE"),
    )


def ingest(
    lines: DataFrame,
    staging_columns: list[str],
    load_ts: Column,
    mode: str = "dynamic",
    mapping_keys: list[str] | None = None,
    dialect: CsvDialect = CsvDialect(),
    listing: DataFrame | None = None,
    headers: DataFrame | None = None,
):
    """lines -> (header info, parsed lines, routing, staging rows).

    ``headers`` (SOURCE_DIR, FILE_NAME, HEADER_LINE) may come from the scan's
    split aggregate; by default they are the lines numbered 1.
    """
    hdr = headers if headers is not None else file_headers(lines)
    info = header_info(hdr, staging_columns, mode, mapping_keys, dialect)
    parsed = parse_lines(lines, info, staging_columns, dialect)
    routing = file_routing(info, parsed, listing)
    staged = staging_rows(parsed, routing, staging_columns, load_ts)
    return info, parsed, routing, staged
