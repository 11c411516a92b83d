"""Staging and audit maintenance: skip-loaded, reload, cleanup, orphans,
cleanup strategy and audit retention.

Each function returns frames, not side effects: ``(keep, drop)`` pairs or the
set of files to drop.  ``sources.tables`` applies them to storage by dropping
whole file partitions, never by rewriting a table it is reading.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdrflow.functions.cleaning import ntz
from cdrflow.mapping import CLEANUP_STRATEGIES

STAGING_KEYS = ["SOURCE_DIR", "SOURCE_FILE"]
AUDIT_FILE = ["SOURCE_DIR", "FILE_NAME"]


def _minus(as_of: str, **kw) -> str:
    return (dt.datetime.fromisoformat(as_of) - dt.timedelta(**kw)).strftime("%Y-%m-%d %H:%M:%S")


def _success_files(audit: DataFrame, since: str | None = None) -> DataFrame:
    a = audit.where((F.col("STATUS") == "SUCCESS") & F.col("FILE_NAME").isNotNull())
    if since is not None:
        a = a.where(F.col("LOAD_TS") >= ntz(since))
    # distinct file keys: a few rows per file, aggregated map-side
    return a.select(F.col("SOURCE_DIR"), F.col("FILE_NAME").alias("SOURCE_FILE")).distinct()


def skip_loaded(listing: DataFrame, audit: DataFrame) -> DataFrame:
    """Listed files not already SUCCESS with the same dir + name + size."""
    done = audit.where(F.col("STATUS") == "SUCCESS").select("SOURCE_DIR", "FILE_NAME", "FILE_SIZE")
    return listing.join(done, ["SOURCE_DIR", "FILE_NAME", "FILE_SIZE"], "left_anti")


def reload(staging: DataFrame, new_rows: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Staging after re-loading some files: their stale rows are replaced,
    every other file is kept.  ``files`` are the files loaded again, also
    those without a row (by default those of ``new_rows``)."""
    gone = (new_rows if files is None else files).select(*STAGING_KEYS).distinct()
    return staging.join(gone, STAGING_KEYS, "left_anti").unionByName(new_rows, allowMissingColumns=True)


def current_files(versions: DataFrame) -> DataFrame:
    """Each file's last load, unless the file was dropped since: one row per file of a version table."""
    more = [c for c in versions.columns if c not in (*STAGING_KEYS, "LOAD", "DROPPED")]
    last = versions.groupBy(*STAGING_KEYS).agg(F.max(F.struct("LOAD", "DROPPED", *more)).alias("LAST"))
    return last.where(~F.col("LAST.DROPPED")).select(*STAGING_KEYS, "LAST.LOAD", *[f"LAST.{c}" for c in more])


def current_rows(rows: DataFrame, versions: DataFrame) -> DataFrame:
    """Rows (with their LOAD) of each file's current version."""
    return rows.join(current_files(versions).select(*STAGING_KEYS, "LOAD"), [*STAGING_KEYS, "LOAD"], "left_semi")


def cleanup(staging: DataFrame, audit: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Staging rows of SUCCESS files are dropped; (keep, drop)."""
    ok = _success_files(audit)
    return staging.join(ok, STAGING_KEYS, "left_anti"), staging.join(ok, STAGING_KEYS, "left_semi")


def orphans(staging: DataFrame, audit: DataFrame, as_of: str, hours: int = 24) -> tuple[DataFrame, DataFrame]:
    """Rows older than ``hours`` whose file has no SUCCESS in the last
    ``hours`` are orphans; (keep, drop).  NULL file names in the audit never
    block the anti join (unlike ``NOT IN``)."""
    since = _minus(as_of, hours=hours)
    recent_ok = _success_files(audit, since)
    old = F.col("LOAD_TS") < ntz(since)
    candidates = staging.join(recent_ok, STAGING_KEYS, "left_anti")
    drop = candidates.where(old)
    keep = staging.join(recent_ok, STAGING_KEYS, "left_semi").unionByName(candidates.where(~old | F.col("LOAD_TS").isNull()))
    return keep, drop


def cleanup_files(outcomes: DataFrame, strategy: str = "on_success") -> DataFrame:
    """Files whose staging rows the transform step drops.

    ``on_success``: files that succeeded; ``on_error``: files that failed
    (only those); ``never``: none.
    """
    if strategy not in CLEANUP_STRATEGIES:
        raise ValueError(f"strategy must be one of {CLEANUP_STRATEGIES}")
    if strategy == "never":
        return outcomes.select(*STAGING_KEYS).where(F.lit(False))
    status = "SUCCESS" if strategy == "on_success" else "ERROR"
    return outcomes.where(F.col("STATUS") == status).select(*STAGING_KEYS)


def retain(audit: DataFrame, as_of: str, days: int = 90) -> tuple[DataFrame, DataFrame]:
    """Audit rows newer than ``days`` are kept; (keep, drop)."""
    old = F.col("LOAD_TS") < ntz(_minus(as_of, days=days))
    return audit.where(~old | F.col("LOAD_TS").isNull()), audit.where(old)
