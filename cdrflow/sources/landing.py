"""Landing folders: file listing and the physical-line scan.

``list_landing`` lists files without reading their bytes (only path, length
and modification time are selected from the binary-file source).

``scan_lines`` reads the text once, split on LF only, and writes the raw lines
with their file, split and row id to the run's folder.  Everything else comes
from that written table, so split offsets and lines can't disagree, whatever
the number of cores or splits at either time:

* rows of one file split are contiguous within a task, and
  ``monotonically_increasing_id`` grows by one per row inside a task, so
  ``id - min(id of the split)`` is the line's offset inside its split;
* one small aggregate per split (count, min id, first line) plus a running
  sum over the splits of each file gives every split's starting line.

A split holds at most ``maxPartitionBytes`` of one file, so the join of lines
to split offsets has no hot key even when one file holds a third of the data.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cdrflow.functions.csvtext import strip_eol
from cdrflow.sources import shared_fs as FS

CSV_GLOB = "*.[cC][sS][vV]"
RAW_SCHEMA = "SOURCE_DIR string, FILE_NAME string, FILE_PATH string, BLOCK bigint, ROW_ID bigint, RAW string"


def list_landing(spark: SparkSession, feeds: dict[str, str], glob: str = CSV_GLOB) -> DataFrame:
    """(SOURCE_DIR, FILE_NAME, FILE_PATH, FILE_SIZE, MTIME) of non-empty CSV files."""
    parts = []
    for feed, path in feeds.items():
        df = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .load(path)
            .select("path", "length", "modificationTime")
        )
        parts.append(
            df.where(F.col("length") > 0).select(
                F.lit(feed).alias("SOURCE_DIR"),
                F.element_at(F.split("path", "/"), -1).alias("FILE_NAME"),
                F.col("path").alias("FILE_PATH"),
                F.col("length").cast("bigint").alias("FILE_SIZE"),
                F.col("modificationTime").alias("MTIME"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def plain_path(path) -> Column:
    """A path as the file listing writes it, from the URL-encoded ``_metadata.file_path``."""
    c = F.col(path) if isinstance(path, str) else path
    plain = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^file:/+", "file:/")


def _literal_path(path: str) -> str:
    """A path in which no character is read as a wildcard."""
    return "".join(f"\\{ch}" if ch in "\\*?[]{}" else ch for ch in path)


def _readable(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are there: one check for all, each alone only if that fails."""

    def there(some: list[str]) -> bool:
        try:
            spark.read.text(some)
            return True
        except AnalysisException:
            return False

    return paths if there(paths) else [p for p in paths if there([p])]


def read_raw(spark: SparkSession, listing: DataFrame, line_sep: str = "\n") -> DataFrame:
    """Raw lines of the listed files, with file, split and row id.

    A file that is gone or can't be read gives no lines, or fewer than it has;
    ``size_check`` finds it by its bytes, and no other file is affected.
    """
    paths = _readable(spark, [_literal_path(r[0]) for r in listing.select("FILE_PATH").distinct().collect()])
    if not paths:
        return spark.createDataFrame([], RAW_SCHEMA)
    reader = spark.read.option("lineSep", line_sep).option("ignoreMissingFiles", "true").option("ignoreCorruptFiles", "true")
    raw = reader.text(paths).select(
        plain_path("_metadata.file_path").alias("_PATH"),
        F.col("_metadata.file_block_start").alias("BLOCK"),
        F.monotonically_increasing_id().alias("ROW_ID"),
        F.col("value").alias("RAW"),
    )
    names = listing.select("SOURCE_DIR", "FILE_NAME", "FILE_PATH", F.regexp_replace("FILE_PATH", "^file:/+", "file:/").alias("_PATH"))
    return raw.join(names, "_PATH").select("SOURCE_DIR", "FILE_NAME", "FILE_PATH", "BLOCK", "ROW_ID", "RAW")


def number_lines(raw: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Lines, per-file facts and headers of raw lines (a written table of ``RAW_SCHEMA``).

    ``lines`` (SOURCE_DIR, FILE_NAME, FILE_PATH, LINE_NO, LINE) have trailing
    CR / LF removed; ``scanned`` is (FILE_PATH, READ_BYTES, LINES), with an LF
    counted for every line; ``headers`` is (SOURCE_DIR, FILE_NAME, HEADER_LINE).
    """
    file = ["SOURCE_DIR", "FILE_NAME", "FILE_PATH"]
    splits = raw.groupBy(*file, "BLOCK").agg(
        F.count(F.lit(1)).alias("N"),
        F.min("ROW_ID").alias("MIN_ID"),
        F.sum(F.octet_length("RAW") + 1).alias("BYTES"),
        F.min_by("RAW", "ROW_ID").alias("FIRST_RAW"),
    )
    w = Window.partitionBy(*file).orderBy("BLOCK").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("OFFSET", F.coalesce(F.sum("N").over(w), F.lit(0)))
    headers = splits.where(F.col("OFFSET") == 0).select(
        "SOURCE_DIR", "FILE_NAME", strip_eol(F.col("FIRST_RAW")).alias("HEADER_LINE")
    )
    scanned = splits.groupBy("FILE_PATH").agg(
        F.sum("BYTES").cast("bigint").alias("READ_BYTES"), F.sum("N").cast("bigint").alias("LINES")
    )
    lines = raw.join(splits.select("FILE_PATH", "BLOCK", "MIN_ID", "OFFSET"), ["FILE_PATH", "BLOCK"]).select(
        *file,
        (F.col("OFFSET") + F.col("ROW_ID") - F.col("MIN_ID") + 1).alias("LINE_NO"),
        strip_eol(F.col("RAW")).alias("LINE"),
    )
    return lines, scanned, headers


def scan_lines(
    spark: SparkSession, listing: DataFrame, line_sep: str = "\n", scratch: str | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``number_lines`` of the listed files: the text is read once and written to ``scratch``.

    Without ``scratch`` a folder of its own is made in the shared folder.
    """
    where = scratch or f"{FS.shared_root(spark)}/_scan-{uuid.uuid4().hex}"
    raw = read_raw(spark, listing, line_sep)
    raw.write.mode("overwrite").parquet(f"{where}/raw")
    return number_lines(spark.read.schema(RAW_SCHEMA).parquet(f"{where}/raw"))


def line_count_errors(lines: DataFrame, scanned: DataFrame) -> DataFrame:
    """(SOURCE_DIR, FILE_NAME, DETAIL) of files whose numbered lines are not 1..LINES (LOAD_ERROR)."""
    counted = lines.groupBy("SOURCE_DIR", "FILE_NAME", "FILE_PATH").agg(
        F.count(F.lit(1)).alias("N"), F.min("LINE_NO").alias("FIRST"), F.max("LINE_NO").alias("LAST")
    )
    wrong = (F.col("N") != F.col("LINES")) | (F.col("FIRST") != 1) | (F.col("LAST") != F.col("LINES"))
    return (
        counted.join(scanned, "FILE_PATH")
        .where(wrong)
        .select("SOURCE_DIR", "FILE_NAME", F.format_string("Line count mismatch: numbered=%d read=%d", F.col("N"), F.col("LINES")).alias("DETAIL"))
    )


def _has_mark(spark: SparkSession, path: str) -> bool:
    return FS.exists(spark, path) and FS.first_bytes(spark, path, 3) == b"\xef\xbb\xbf"


def size_check(listing: DataFrame, scanned: DataFrame) -> DataFrame:
    """Files of which not all listed bytes were read (DOWNLOAD_ERROR).

    The last line may lack its LF.  The reader drops a byte order mark, so two
    or three bytes may be missing from a file that begins with one: only of
    files that miss so many, the first bytes are looked at.
    """
    read = F.coalesce(F.col("READ_BYTES"), F.lit(0))
    lost = F.col("FILE_SIZE") - read
    spark = listing.sparkSession
    short = listing.join(scanned, "FILE_PATH").where(lost.isin(2, 3)).select("FILE_PATH").distinct()
    marked = [(r[0],) for r in short.toLocalIterator() if _has_mark(spark, r[0])]
    excused = spark.createDataFrame(marked, "FILE_PATH string").withColumn("_MARK", F.lit(True))
    return (
        listing.join(scanned, "FILE_PATH", "left").join(excused, "FILE_PATH", "left")
        .where(~(lost.isin(0, -1) | (lost.isin(2, 3) & F.col("_MARK").isNotNull())))
        .select(
            "SOURCE_DIR", "FILE_NAME", "FILE_PATH", "FILE_SIZE",
            F.format_string("Size mismatch: local=%d expected=%d", read, F.col("FILE_SIZE")).alias("DETAIL"),
        )
    )
