"""The life of each file as a keyed state over the audit log, with a timer for the orphan rule.

The audit is a stream of events (DOWNLOADED, SUCCESS, ERROR, by file).  A file's
first event without a success sets a timer; a success ends the life and
reports how long it took; a timer that the watermark passes reports an orphan.
State is kept only for files that are under way, and spread over the cluster
by file.  Needs the RocksDB state store (``configure_state_store``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cdrflow.sources import generations as G
from cdrflow.sources.tables import AUDIT_EVENT_SCHEMA

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEYS = ["SOURCE_DIR", "FILE_NAME"]
REPORT_SCHEMA = "SOURCE_DIR string, FILE_NAME string, REPORT string, LAST_STATUS string, FIRST_MS bigint, AT_MS bigint"


def configure_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


class FileLife(StatefulProcessor):
    """One file: when it was first seen, and its last status."""

    def __init__(self, orphan_ms: int):
        self.orphan_ms = orphan_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.life = handle.getValueState("life", "FIRST_MS bigint, LAST_STATUS string")

    def _stop(self) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.life.clear()

    def _report(self, key: tuple, what: str, first: int, status: str, at: int):
        import pandas as pd

        names = [c.split()[0] for c in REPORT_SCHEMA.split(", ")]
        return pd.DataFrame([(*key, what, status, first, at)], columns=names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        events = sorted((int(r.AT_MS), int(r.SEQ), r.STATUS) for part in rows for r in part.itertuples())
        first, status = self.life.get() if self.life.exists() else (None, None)
        for at, _, now in events:
            if now == "SUCCESS":
                yield self._report(key, "DONE", at if first is None else first, now, at)
                self._stop()
                first = None
                continue
            if first is None:
                first = at
                self.handle.registerTimer(first + self.orphan_ms)
            self.life.update((first, now))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        if self.life.exists():
            first, status = self.life.get()
            yield self._report(key, "ORPHAN", first, status, expiredTimerInfo.getExpiryTimeInMs())
            self._stop()

    def close(self) -> None:
        pass


def audit_stream(spark: SparkSession, audit_path: str) -> DataFrame:
    """Audit events as they are appended; a query on it starts anew after the retention has replaced the audit."""
    return spark.readStream.schema(AUDIT_EVENT_SCHEMA).parquet(G.current(spark, audit_path))


def file_lives(events: DataFrame, orphan_hours: float = 24, delay: str = "0 seconds") -> DataFrame:
    """(SOURCE_DIR, FILE_NAME, REPORT, LAST_STATUS, FIRST_MS, AT_MS): DONE at a success, ORPHAN without one in time.

    Times are milliseconds of the load times, read as UTC.  ``delay`` is how
    late events may come.  Events without a file name are left out.
    """
    at_ms = F.timestamp_diff("MILLISECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), "LOAD_TS")
    timed = events.where(F.col("FILE_NAME").isNotNull()).select(
        *KEYS, "STATUS", "SEQ", at_ms.alias("AT_MS"), F.timestamp_millis(at_ms).alias("AT")
    )
    return (
        timed.withWatermark("AT", delay)
        .groupBy(*KEYS)
        .transformWithStateInPandas(FileLife(int(orphan_hours * 3_600_000)), REPORT_SCHEMA, "Append", "EventTime")
    )
