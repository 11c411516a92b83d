"""The life of files as streaming state: done in time, orphaned, and done after all."""

from __future__ import annotations

from pyspark.sql import functions as F

from cdrflow.operators import audit as A
from cdrflow.plans import fixtures as FX
from cdrflow.sources import tables as TB
from cdrflow.streaming import lifecycle as LC


def test_a_file_without_success_is_reported_after_its_timer(spark, tmp_path):
    path, before = str(tmp_path / "audit"), spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    seq = [0]

    def events(ts, **status):
        rows = spark.createDataFrame([("OCC", f"{f}.csv", 1, s) for f, s in status.items()], "SOURCE_DIR string, FILE_NAME string, FILE_SIZE bigint, S string")
        TB.append_audit(A.audit_event(rows, F.col("S"), FX.ntz(ts), seq=seq[0]), path)
        seq[0] += 1

    def run():
        q = (LC.file_lives(LC.audit_stream(spark, path), 24).writeStream.format("parquet").outputMode("append")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted((r.FILE_NAME, r.REPORT, r.LAST_STATUS) for r in spark.read.schema(LC.REPORT_SCHEMA).parquet(str(tmp_path / "out")).collect())

    LC.configure_state_store(spark)
    try:
        events("2024-01-30 00:00:00", a="DOWNLOADED", b="DOWNLOADED", c="DOWNLOADED")
        events("2024-01-30 00:05:00", a="SUCCESS", b="ERROR")
        done = [("a.csv", "DONE", "SUCCESS")]
        assert run() == done
        events("2024-01-30 20:00:00", c="SUCCESS", d="DOWNLOADED")
        done = [*done, ("c.csv", "DONE", "SUCCESS")]
        assert run() == done  # b's 24 hours are not over
        events("2024-01-31 00:10:00", e="DOWNLOADED")
        assert run() == [done[0], ("b.csv", "ORPHAN", "ERROR"), done[1]]
        events("2024-01-31 01:00:00", b="SUCCESS")  # a later load of the orphan
        assert ("b.csv", "DONE", "SUCCESS") in run()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
