"""One load run over every pending landing file, as a handful of Spark jobs.

lease -> finish moves of an earlier run -> list -> skip already loaded -> audit
DOWNLOADED -> scan + number lines -> size check -> strict parse / whitelist /
routing -> staging (a version per load) -> transform -> merge
(insert-if-absent) -> detail and key tables -> audit SUCCESS / ERROR -> staging
cleanup -> files to OUT / ERR.

All files of a run move together; file identity travels as columns, and what is
known of each file stays in written tables that are joined by file.  There are
no transactions on parquet, so the write order is staging -> pending keys ->
detail -> keys -> move journal -> audit last: a run that dies before its audit
rows is simply run again; the skip / version / insert-if-absent steps make that
harmless, and pending keys whose rows reached the detail are added to the key
table first.

Rows are reconciled on the way: each written step observes how many rows it
writes, in the stage that writes them, and a file, or a whole step, whose rows
do not add up ends as an error in the audit instead of loading.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdrflow.functions.cleaning import ntz
from cdrflow.mapping import DEDUP_KEYS, MAPPINGS, STATUS_DOWNLOADED, TECHNICAL_COLUMNS
from cdrflow.operators import audit as A
from cdrflow.operators import maintain as MT
from cdrflow.operators import merge as MG
from cdrflow.operators import transform as TR
from cdrflow.session import configure
from cdrflow.sources import csv_ingest as CI
from cdrflow.sources import landing as L
from cdrflow.sources import moves as MV
from cdrflow.sources import tables as TB
from cdrflow.sources import versions as V
from cdrflow.sources.lease import RunLease

FILE = ["SOURCE_DIR", "FILE_NAME"]


@dataclass(frozen=True)
class Warehouse:
    root: str

    @property
    def staging(self) -> str:
        return f"{self.root}/staging"

    @property
    def detail(self) -> str:
        return f"{self.root}/detail"

    @property
    def rejects(self) -> str:
        """Rejected rows of the latest load of each file, with all their reasons."""
        return f"{self.root}/rejects"

    @property
    def pending_keys(self) -> str:
        return f"{self.root}/_pending_keys"

    @property
    def audit(self) -> str:
        return f"{self.root}/audit"

    @property
    def lease(self) -> str:
        return f"{self.root}/_lease"

    @property
    def moves(self) -> str:
        return f"{self.root}/_moves"

    @property
    def progress(self) -> str:
        """Rows that each step of each run wrote."""
        return f"{self.root}/progress"

    def scratch(self, run_id: str) -> str:
        return f"{self.root}/_runs/{run_id}"


@dataclass(frozen=True)
class LoadOptions:
    on_duplicate: str = "fail_file"
    cleanup: str = "on_success"
    whitelist_mode: str = "dynamic"
    unit: str = "seconds"
    dialect: CI.CsvDialect = CI.CsvDialect()
    overflow: str = "fail_file"  # or "null"
    key_table: str | None = None  # bucketed catalog table for the keys
    key_buckets: int = 64  # of a new key table: about its final size / 1 GB
    sequential: bool = False  # exact file-by-file merge (reference order) instead of one batch
    # staging layout (= dynamic whitelist) per feed beyond the mapping's
    # source columns, e.g. {"OCC": ["AGGREGATION_GROUP", "A_IMSI", ...]}
    staging_columns: dict | None = None
    validate: str = "raw"  # whitelist the raw header names (reference) or the sanitized ones
    routes: MV.Routes | None = None  # folders for loaded and failed files; None leaves them where they are
    lease_seconds: float = 900  # a run that shows no sign of life for so long may be taken over


def _next_seq(events: DataFrame) -> int:
    """Order of this run's audit events: after all that are there, whatever any clock says."""
    last = events.agg(F.max("SEQ")).first()[0]
    return 0 if last is None else int(last) + 1


def recover_keys(spark: SparkSession, wh: Warehouse, feed: str, table: str, buckets: int) -> None:
    """Add the keys of a run that was lost between its detail and its key append.

    The run's pending keys are a written table; those that are in the detail,
    but not in the key table, are added.
    """
    path = f"{wh.pending_keys}/{feed}"
    if not TB.exists(spark, path):
        return
    if TB.exists(spark, wh.detail):
        key_col = DEDUP_KEYS[feed][0]
        loaded = spark.read.schema(f"{key_col} string").parquet(wh.detail).select(F.col(key_col).alias("DEDUP_KEY"))
        pending = spark.read.schema("DEDUP_KEY string").parquet(path)
        missing = pending.join(loaded, "DEDUP_KEY", "left_semi").join(TB.read_keys(spark, table), "DEDUP_KEY", "left_anti")
        TB.append_keys(missing, table, buckets)
    TB.delete_path(spark, path)


def _staging_columns(spark: SparkSession, wh: Warehouse, feed: str, info: DataFrame,
                     extra: list[str] | None = None) -> tuple[list[str], str]:
    """Whitelist / staging columns of a feed and the effective mode."""
    mapping = MAPPINGS.get(feed, ())
    if mapping:
        cols = [s.source for s in mapping]
        return cols + [c for c in (extra or []) if c not in cols and c not in TECHNICAL_COLUMNS], "dynamic"
    # No mapping (e.g. MMG): the staging layout follows the headers.
    names = sorted({n for r in info.select(F.explode("HEADER_COLS")).distinct().collect() for n in r})
    return [n for n in names if n not in TECHNICAL_COLUMNS], "permissive"


def _existing_keys(spark: SparkSession, wh: Warehouse, feed: str, options: LoadOptions) -> DataFrame:
    """Keys already loaded.

    By default the detail table's own key column (parquet reads just that
    column): one table is the only truth, so a run lost after its detail
    append leaves nothing to re-insert.  With ``key_table`` the keys come from
    the bucketed catalog table (no shuffle of the key side), after
    ``recover_keys`` has completed it.
    """
    if options.key_table is not None:
        recover_keys(spark, wh, feed, options.key_table, options.key_buckets)
        return TB.read_keys(spark, options.key_table)
    key_col = DEDUP_KEYS[feed][0]
    if TB.exists(spark, wh.detail):
        # explicit one-column schema: only the key column is read, and a
        # detail folder holding no rows yet reads as no keys
        return spark.read.schema(f"{key_col} string").parquet(wh.detail).select(F.col(key_col).alias("DEDUP_KEY"))
    return spark.createDataFrame([], "DEDUP_KEY string")


class Progress:
    """Rows written by each step of a run, observed in the stage that writes them.

    There a task counts once, however often it or a stage before it was run
    again.
    """

    def __init__(self, spark: SparkSession, seq: int):
        self.spark, self.seq, self.rows = spark, seq, []

    def write(self, step: str, feed: str, df: DataFrame, path: str) -> tuple[DataFrame, int]:
        """Write ``df`` and read it back; how many rows were written."""
        seen = Observation(f"{step}-{feed}-{uuid.uuid4().hex[:8]}")
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), self.note(step, feed, seen)

    def note(self, step: str, feed: str, seen: Observation) -> int:
        n = int(seen.get.get("rows", 0))
        self.rows.append((self.seq, feed, step, n))
        return n

    def save(self, path: str) -> None:
        if self.rows:
            schema = "SEQ bigint, SOURCE_DIR string, STEP string, ROWS bigint"
            self.spark.createDataFrame(self.rows, schema).coalesce(1).write.mode("append").parquet(path)


def _total(df: DataFrame, column: Column) -> int:
    return int(df.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0])


def _mismatch(what: str, a: str, n: int, b: str, m: int) -> str | None:
    return None if n == m else f"Row count mismatch after {what}: {a}={n} {b}={m}"


def _transform_merge(spark: SparkSession, wh: Warehouse, feed: str, routing: DataFrame, cols: T.StructType, seq: int,
                     scratch: str, options: LoadOptions, progress: Progress, files: DataFrame | None = None,
                     lease: RunLease | None = None) -> DataFrame:
    """Transform + merge the staged rows of this run; append detail and keys.

    One row per good file of ``routing`` (of ``files`` where given): SOURCE_DIR,
    FILE_NAME, TMP_ROWS, INSERTED, DUPLICATES, REJECTED_ROWS, TRANSFORM_ERROR.
    """
    staged_files = routing.where(F.col("STATUS") == "SUCCESS").select("SOURCE_DIR", F.col("FILE_NAME").alias("SOURCE_FILE"), "ROWS_CSV")
    stg = V.read_load(spark, wh.staging, seq, cols).where(F.col("SOURCE_DIR") == feed)
    if files is not None:
        staged_files = staged_files.join(files, TR.FILE_KEYS, "left_semi")
        stg = stg.join(files, TR.FILE_KEYS, "left_semi")
    # the flag projection is the CPU-heavy step: computed once, written, then
    # read by the checks, the merge and the stats
    flagged, n_flagged = progress.write(
        "flagged", feed, TR.flag(stg, MAPPINGS[feed], DEDUP_KEYS[feed], options.unit, keep=["SOURCE_LINE"]), f"{scratch}/flagged"
    )
    V.add(TR.reject_rows(flagged), wh.rejects, seq)
    valid = TR.valid_rows(flagged)

    # files that may not be merged: rows lost or added on the way, or a number out of range
    counts = staged_files.join(TR.file_counts(flagged), TR.FILE_KEYS, "full")
    staged_n, parsed_n = F.coalesce("TMP_ROWS", F.lit(0)), F.coalesce("ROWS_CSV", F.lit(0))
    over = (F.coalesce("OVERFLOW_ROWS", F.lit(0)) > 0) if options.overflow == "fail_file" else F.lit(False)
    barred = counts.select(
        *TR.FILE_KEYS,
        F.when(staged_n != parsed_n, F.format_string("Row count mismatch: parsed=%d staged=%d", parsed_n, staged_n))
        .when(over, F.lit("numeric value out of range for the detail column")).alias("WHY"),
    ).where("WHY IS NOT NULL")
    barred, _ = progress.write("barred_files", feed, barred, f"{scratch}/barred")
    total = _mismatch("transform", "parsed", _total(staged_files, F.col("ROWS_CSV")), "flagged", n_flagged)
    if total and barred.isEmpty():  # no file shows it: none is loaded
        barred = staged_files.select(*TR.FILE_KEYS, F.lit(total).alias("WHY"))
    valid = valid.join(barred, TR.FILE_KEYS, "left_anti")

    keys = _existing_keys(spark, wh, feed, options)
    to_insert, failed = MG.merge_insert_absent(valid, keys, "DEDUP_KEY", "DEDUP_KEY", options.on_duplicate, ("SOURCE_LINE",))
    # cut lineage: failed files and merge result are written once, before the
    # keys they were decided by change, and every later step reads them
    failed, _ = progress.write("failed_files", feed, failed, f"{scratch}/failed")
    inserted, n_merged = progress.write(
        "merged", feed,
        to_insert.select(*TR.detail_projection(MAPPINGS[feed], DEDUP_KEYS[feed]), "DEDUP_KEY", *TR.FILE_KEYS),
        f"{scratch}/inserted",
    )
    detail_cols = [c for c in inserted.columns if c not in ("DEDUP_KEY", *TR.FILE_KEYS)]
    if lease is not None:
        lease.check()
    if options.key_table is not None:
        inserted.select("DEDUP_KEY").write.mode("overwrite").parquet(f"{wh.pending_keys}/{feed}")
    seen = Observation(f"detail-{uuid.uuid4().hex[:8]}")
    TB.append_detail(inserted.select(*detail_cols), wh.detail, seen)
    lost = _mismatch("merge", "merged", n_merged, "detail", progress.note("detail", feed, seen))
    if options.key_table is not None:
        TB.append_keys(inserted.select("DEDUP_KEY"), options.key_table, options.key_buckets)
        TB.delete_path(spark, f"{wh.pending_keys}/{feed}")

    stats = TR.transform_stats(flagged, inserted, failed)
    out = staged_files.select(*TR.FILE_KEYS).join(stats, TR.FILE_KEYS, "left").join(barred, TR.FILE_KEYS, "left")
    numbers = ["TMP_ROWS", "INSERTED", "DUPLICATES", "REJECTED_ROWS"]
    wrong = F.coalesce(
        F.col("WHY"),
        F.when(F.col("FAILED"), F.lit("unique key violated (duplicate key inside the file)")),
        F.when(F.col("INSERTED") > 0, F.lit(lost).cast("string")),
    )
    out = out.select(
        "SOURCE_DIR", F.col("SOURCE_FILE").alias("FILE_NAME"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        A.error_message("TRANSFORM_ERROR", wrong).alias("_MESSAGE"), wrong.alias("_WRONG"),
    ).select("SOURCE_DIR", "FILE_NAME", *numbers, F.when(F.col("_WRONG").isNotNull(), F.col("_MESSAGE")).alias("TRANSFORM_ERROR"))
    return progress.write("file_results", feed, out, f"{scratch}/results")[0]


PENDING_SCHEMA = "SOURCE_DIR string, FILE_NAME string, FILE_PATH string, FILE_SIZE bigint, MTIME timestamp"
OUTCOME_SCHEMA = (
    "SOURCE_DIR string, FILE_NAME string, STATUS string, MESSAGE string, ROWS_CSV bigint, "
    "ROWS_DB bigint, INSERTED bigint, DUPLICATES bigint"
)


def run_load(
    spark: SparkSession,
    feeds: dict[str, str],
    warehouse: str,
    load_ts: str,
    options: LoadOptions = LoadOptions(),
    listing: DataFrame | None = None,
) -> DataFrame:
    """Load every pending file of ``feeds`` ({feed: folder}); returns the
    outcome row of each file (audit columns + INSERTED / DUPLICATES).

    Raises ``RunInProgress`` where another run works on the warehouse."""
    configure(spark)
    wh = Warehouse(warehouse.rstrip("/"))
    run_id = uuid.uuid4().hex[:12]
    ts = ntz(load_ts)
    scratch = wh.scratch(run_id)

    with RunLease(spark, wh.lease, options.lease_seconds, run_id) as lease:
        try:
            events = TB.read_audit_events(spark, wh.audit)
            MV.replay(spark, wh.moves, events)
            seq = max(_next_seq(events), V.next_load(spark, wh.staging))

            # 1. listing minus files already loaded; frozen (file metadata) so later
            #    steps see the same set even if new files land meanwhile.
            listed = listing if listing is not None else L.list_landing(spark, feeds)
            todo = MT.skip_loaded(listed, A.audit_latest(events))
            todo.select("SOURCE_DIR", "FILE_NAME", "FILE_PATH", "FILE_SIZE", "MTIME").write.parquet(f"{scratch}/pending")
            pending = spark.read.schema(PENDING_SCHEMA).parquet(f"{scratch}/pending")
            if pending.isEmpty():
                return spark.createDataFrame([], T.StructType(A.audit_event(pending, "X", ts).schema.fields))
            lease.check()
            TB.append_audit(A.audit_event(pending, STATUS_DOWNLOADED, ts, seq=seq), wh.audit)
            return _load_pending(spark, wh, pending, scratch, options, ts, seq + 1, lease)
        finally:
            TB.delete_path(spark, scratch)


def _stage(spark: SparkSession, wh: Warehouse, feed: str, pending: DataFrame, scratch: str, options: LoadOptions, ts,
           seq: int, progress: Progress) -> tuple[DataFrame, T.StructType]:
    """Scan, check and parse the feed's pending files and stage the rows of the good ones: (routing, staging layout)."""
    # 2. physical lines of this feed's files (the text is read once), plus size check
    feed_listing = pending.where(F.col("SOURCE_DIR") == feed)
    feed_lines, scanned, feed_headers = L.scan_lines(spark, feed_listing, "\n", f"{scratch}/scan_{feed}")
    size_err = L.size_check(feed_listing, scanned).select(*FILE, F.col("DETAIL").alias("DOWNLOAD_ERROR"))
    info0 = CI.header_info(feed_headers, None, "permissive", None, options.dialect)
    cols, mode = _staging_columns(spark, wh, feed, info0, (options.staging_columns or {}).get(feed))
    mode = options.whitelist_mode if MAPPINGS.get(feed) else mode
    mapping_keys = [s.source for s in MAPPINGS.get(feed, ())]
    info = CI.header_info(feed_headers, cols, mode, mapping_keys, options.dialect, options.validate)
    # parse once; routing and staging both read the written result
    parsed, n_parsed = progress.write("parsed", feed, CI.parse_lines(feed_lines, info, cols, options.dialect), f"{scratch}/parsed_{feed}")
    routing = CI.file_routing(info, parsed, feed_listing)
    # a size mismatch wins over every later check, and lines that do not
    # number 1..n over a file that seemed well
    count_err = L.line_count_errors(feed_lines, scanned).select(*FILE, F.col("DETAIL").alias("COUNT_ERROR"))
    later = F.when(
        (F.col("STATUS") == "SUCCESS") & F.col("COUNT_ERROR").isNotNull(), A.error_message("LOAD_ERROR", F.col("COUNT_ERROR"))
    ).otherwise(F.col("MESSAGE"))
    routing = routing.join(size_err, FILE, "left").join(count_err, FILE, "left").select(
        *FILE,
        F.when(F.col("DOWNLOAD_ERROR").isNotNull(), A.error_message("DOWNLOAD_ERROR", F.col("DOWNLOAD_ERROR")))
        .otherwise(later).alias("MESSAGE"),
        "ROWS_CSV",
    ).withColumn("STATUS", F.when(F.col("MESSAGE").isNull(), F.lit("SUCCESS")).otherwise(F.lit("ERROR")))
    routing, _ = progress.write("routed_files", feed, routing, f"{scratch}/routing_{feed}")

    # 3. the new version of every file of the run, also of those without a good row
    staged = CI.staging_rows(parsed, routing, cols, ts)
    files = feed_listing.select("SOURCE_DIR", F.col("FILE_NAME").alias("SOURCE_FILE"))
    V.begin(files, wh.staging, seq, staged.schema)
    V.begin(files, wh.rejects, seq, T.StructType(REJECT_FIELDS))
    seen = Observation(f"staged-{uuid.uuid4().hex[:8]}")
    V.add(staged.observe(seen, F.count(F.lit(1)).alias("rows")), wh.staging, seq)
    n_staged = progress.note("staged", feed, seen)

    good = F.when(F.col("STATUS") == "SUCCESS", F.col("ROWS_CSV"))
    wrong = _mismatch("parse", "parsed", n_parsed, "routed", _total(routing, F.col("ROWS_CSV"))) or _mismatch(
        "staging", "parsed", _total(routing, good), "staged", n_staged
    )
    if wrong and not MAPPINGS.get(feed):  # with a mapping, the transform names the files
        bad = F.col("STATUS") == "SUCCESS"
        routing = routing.withColumn("MESSAGE", F.when(bad, A.error_message("LOAD_ERROR", wrong)).otherwise(F.col("MESSAGE")))
        routing = routing.withColumn("STATUS", F.lit("ERROR"))
    return routing, staged.schema


REJECT_FIELDS = [
    T.StructField("SOURCE_DIR", T.StringType(), True),
    T.StructField("SOURCE_FILE", T.StringType(), True),
    T.StructField("SOURCE_LINE", T.LongType(), True),
    T.StructField("REASONS", T.StringType(), True),
]


def _load_pending(
    spark: SparkSession, wh: Warehouse, pending: DataFrame, scratch: str, options: LoadOptions, ts, seq: int, lease: RunLease
) -> DataFrame:
    """Scan, route, stage, transform and merge the pending files; audit rows get ``seq``."""
    progress = Progress(spark, seq)
    results = spark.createDataFrame([], OUTCOME_SCHEMA)
    for feed in sorted(r[0] for r in pending.select("SOURCE_DIR").distinct().collect()):  # as many as there are feeds
        routing, cols = _stage(spark, wh, feed, pending, scratch, options, ts, seq, progress)
        # 4. transform + merge where the feed has a mapping
        if MAPPINGS.get(feed):
            args = (spark, wh, feed, routing, cols, seq)
            if options.sequential:
                # file by file in name order, each seeing the keys the previous files inserted
                names = [r[0] for r in routing.where(F.col("STATUS") == "SUCCESS").select("FILE_NAME").orderBy("FILE_NAME").collect()]
                merged = spark.createDataFrame([], MERGED_SCHEMA)
                for i, name in enumerate(names):
                    one = spark.createDataFrame([(feed, name)], "SOURCE_DIR string, SOURCE_FILE string")
                    merged = merged.unionByName(_transform_merge(*args, f"{scratch}/{feed}_{i}", options, progress, one, lease))
            else:
                merged = _transform_merge(*args, f"{scratch}/{feed}_0", options, progress, None, lease)
        else:
            merged = spark.createDataFrame([], MERGED_SCHEMA)
            routing = routing.withColumn("MESSAGE", F.coalesce(
                F.col("MESSAGE"), F.lit(f"TRANSFORM_ERROR: {feed} transformation not implemented yet")))
        merged = merged.withColumn("_MERGED", F.lit(True))
        message = F.coalesce(F.col("MESSAGE"), F.col("TRANSFORM_ERROR"))
        ok = message.isNull()
        done = F.when(ok, F.concat(F.lit("TMP:"), "TMP_ROWS", F.lit(" DETAIL:"), "INSERTED", F.lit(" REJECTED:"), "REJECTED_ROWS"))
        feed_out = routing.join(merged, FILE, "left").select(
            *FILE,
            F.when(ok, F.lit("SUCCESS")).otherwise(F.lit("ERROR")).alias("STATUS"),
            F.coalesce(message, done).alias("MESSAGE"),
            "ROWS_CSV",
            *[F.when(ok, F.col(c)).alias(n) for c, n in (("TMP_ROWS", "ROWS_DB"), ("INSERTED", "INSERTED"), ("DUPLICATES", "DUPLICATES"))],
        )
        results = results.unionByName(feed_out)
    out, _ = progress.write("outcomes", "", results.join(pending.select(*FILE, "FILE_SIZE"), FILE), f"{scratch}/outcomes")
    progress.save(wh.progress)

    # 5. the renames this run intends, then its audit, then the cleanup of staging and the renames
    if options.routes is not None:
        listed = pending.select(*FILE, "FILE_PATH", "MTIME")
        MV.write_journal(MV.intended(out.join(listed, FILE), options.routes), wh.moves, seq)
    lease.check()
    TB.append_audit(
        A.audit_event(out, F.col("STATUS"), ts, F.col("MESSAGE"), F.col("ROWS_CSV"), F.col("ROWS_DB"),
                      seq=seq),
        wh.audit,
    )
    drop = MT.cleanup_files(out.select(*FILE, "STATUS").withColumnRenamed("FILE_NAME", "SOURCE_FILE"), options.cleanup)
    TB.drop_staging_files(spark, wh.staging, drop)
    V.vacuum(spark, wh.rejects)
    if options.routes is not None:
        MV.replay(spark, wh.moves, TB.read_audit_events(spark, wh.audit))
    return spark.createDataFrame(out.collect(), out.schema)  # detached from the run's files


MERGED_SCHEMA = (
    "SOURCE_DIR string, FILE_NAME string, TMP_ROWS bigint, INSERTED bigint, DUPLICATES bigint, "
    "REJECTED_ROWS bigint, TRANSFORM_ERROR string"
)


def clean_up(spark: SparkSession, warehouse: str, as_of: str, retention_days: int = 90, orphan_hours: int = 24,
             lease_seconds: float = 900) -> None:
    """Apply audit retention and drop the staging rows of orphaned files on storage.

    A file is an orphan when all its staging rows are older than
    ``orphan_hours`` and it had no success since.  Each step is atomic and may
    be repeated; no load runs meanwhile.
    """
    wh = Warehouse(warehouse.rstrip("/"))
    with RunLease(spark, wh.lease, lease_seconds, "clean_up") as lease:
        events = TB.read_audit_events(spark, wh.audit)
        staged = TB.read_staging(spark, wh.staging)
        if "LOAD_TS" in staged.columns:
            staged = staged.select(*MT.STAGING_KEYS, "LOAD_TS")
            keep, drop = MT.orphans(staged, A.audit_latest(events), as_of, orphan_hours)
            files = drop.select(*MT.STAGING_KEYS).distinct().join(keep.select(*MT.STAGING_KEYS), MT.STAGING_KEYS, "left_anti")
            lease.check()
            TB.drop_staging_files(spark, wh.staging, files)
            V.compact(spark, wh.staging)
        if TB.exists(spark, wh.rejects):
            V.compact(spark, wh.rejects)
        if not events.isEmpty():
            lease.check()
            TB.replace_audit(MT.retain(events, as_of, retention_days)[0], wh.audit)
