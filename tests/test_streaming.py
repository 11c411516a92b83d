"""Incremental mode: new landing files are picked up exactly once."""

from __future__ import annotations

from conftest import SF001
from helpers import write_landing
from pyspark.sql import functions as F

from cdrflow.operators.audit import audit_latest
from cdrflow.plans.batch_load import LoadOptions
from cdrflow.sources import tables as TB
from cdrflow.streaming.incremental import start_incremental


def test_incremental_picks_new_files_once(spark, tmp_path):
    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    wh, ck = str(tmp_path / "wh"), str(tmp_path / "ck")
    clock = iter(["2024-01-31 00:00:00", "2024-01-31 00:10:00", "2024-01-31 00:20:00", "2024-01-31 00:30:00"])
    opts = LoadOptions(cleanup="never")
    q = start_incremental(spark, feeds, wh, ck, "availableNow", opts, clock=lambda: next(clock))
    q.awaitTermination(600)
    assert q.exception() is None
    seen = [p["observedMetrics"]["landing"] for p in q.recentProgress if p.get("observedMetrics", {}).get("landing")]
    assert sum(int(m["files"]) for m in seen) == 20
    cur = audit_latest(TB.read_audit_events(spark, f"{wh}/audit"))
    assert cur.count() == 20
    n_detail = spark.read.parquet(f"{wh}/detail").count()
    assert n_detail > 0

    # a new file lands; the same checkpoint only sees the new file
    src = tmp_path / "landing" / "OCC" / "CDR_OCC_00.csv"
    lines = src.read_text().split("\n")
    new_lines = [lines[0]] + [l.replace('"CH', '"NEWCH') for l in lines[1:] if l]
    (tmp_path / "landing" / "OCC" / "CDR_OCC_20.csv").write_text("\n".join(new_lines) + "\n")
    q2 = start_incremental(spark, feeds, wh, ck, "availableNow", opts, clock=lambda: next(clock))
    q2.awaitTermination(600)
    assert q2.exception() is None
    cur = audit_latest(TB.read_audit_events(spark, f"{wh}/audit"))
    assert cur.count() == 21
    row = cur.where(F.col("FILE_NAME") == "CDR_OCC_20.csv").first()
    assert row.STATUS == "SUCCESS"
    # the earlier files were not loaded twice
    events = TB.read_audit_events(spark, f"{wh}/audit")
    assert events.where(F.col("FILE_NAME") == "CDR_OCC_00.csv").count() == 2  # DOWNLOADED + final


def test_archive_processed_files(spark, tmp_path):
    """I5: with cleanSource=archive, files of completed batches move to the
    archive folder (best effort: the last batch's files stay in place)."""
    import glob

    landing = tmp_path / "landing" / "OCC"
    landing.mkdir(parents=True)
    for i in range(3):
        (landing / f"CDR_OCC_{i}.csv").write_text("DATASOURCE,A_MSISDN\nOCC,1\n")
    q = start_incremental(spark, {"OCC": str(landing)}, str(tmp_path / "wh"), str(tmp_path / "ck"), "availableNow",
                          LoadOptions(cleanup="never"), clock=lambda: "2024-01-31 00:00:00", max_files=1,
                          archive_dir=str(tmp_path / "archive"))
    q.awaitTermination(600)
    assert q.exception() is None
    archived = glob.glob(str(tmp_path / "archive" / "**" / "*.csv"), recursive=True)
    assert len(archived) >= 1
    assert len(archived) + len(list(landing.glob("*.csv"))) == 3
    cur = audit_latest(TB.read_audit_events(spark, str(tmp_path / "wh" / "audit")))
    assert cur.count() == 3


def test_replayed_and_overlapping_batches_insert_nothing_twice(spark, tmp_path):
    """I3, I4: the same files again, after a lost checkpoint, and a later file with keys that are loaded."""
    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    src = tmp_path / "landing" / "OCC"
    for f in src.glob("*.csv"):
        if f.name not in ("CDR_OCC_00.csv", "CDR_OCC_02.csv"):
            f.unlink()
    wh = str(tmp_path / "wh")
    opts = LoadOptions(cleanup="never", on_duplicate="keep_first")

    def batch(name):
        q = start_incremental(spark, feeds, wh, str(tmp_path / name), "availableNow", opts, clock=lambda: "2024-01-31 00:00:00")
        q.awaitTermination(600)
        assert q.exception() is None
        return spark.read.parquet(f"{wh}/detail").count()

    n = batch("ck1")
    (src / "CDR_OCC_20.csv").write_text((src / "CDR_OCC_00.csv").read_text())
    assert batch("ck1") == n  # another file, the same keys
    assert batch("ck2") == n  # every file is listed again
    events = TB.read_audit_events(spark, f"{wh}/audit")
    assert events.where(F.col("FILE_NAME") == "CDR_OCC_00.csv").count() == 2
    row = audit_latest(events).where(F.col("FILE_NAME") == "CDR_OCC_20.csv").first()
    assert row.STATUS == "SUCCESS" and "DETAIL:0" in row.MESSAGE
