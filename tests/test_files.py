"""Real files on disk: line numbering across splits, the load job, reruns."""

from __future__ import annotations

import os

from conftest import SF001
from helpers import write_landing
from pyspark.sql import functions as F

from cdrflow.operators.audit import audit_latest
from cdrflow.plans.batch_load import LoadOptions, run_load
from cdrflow.sources import landing as L
from cdrflow.sources import tables as TB


def test_scan_lines_numbers_every_physical_line(spark, tmp_path):
    folder = tmp_path / "OCC"
    folder.mkdir()
    expect = {}
    for n in range(3):
        lines = [f"H{n}"] + [("" if i % 17 == 0 else f"row,{n},{i}," + "x" * (i % 40)) for i in range(1, 3000)]
        lines[5] = lines[5] + "\r"  # CR before LF
        (folder / f"f{n}.csv").write_bytes(("\n".join(lines) + "\n").encode())
        expect[f"f{n}.csv"] = [(i + 1, l.rstrip("\r")) for i, l in enumerate(lines)]
    (folder / "empty.csv").write_bytes(b"")
    (folder / "skip.txt").write_bytes(b"a\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many splits per file
    try:
        listing = L.list_landing(spark, {"OCC": str(folder)})
        assert sorted(r.FILE_NAME for r in listing.collect()) == ["f0.csv", "f1.csv", "f2.csv"]
        lines, scanned, headers = L.scan_lines(spark, listing)
        assert sorted((r.FILE_NAME, r.HEADER_LINE) for r in headers.collect()) == [(f'f{n}.csv', f'H{n}') for n in range(3)]
        got = {}
        for r in lines.collect():
            got.setdefault(r.FILE_NAME, []).append((r.LINE_NO, r.LINE))
        for k in expect:
            assert sorted(got[k]) == expect[k]
        assert L.size_check(listing, scanned).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_load_job_end_to_end(spark, tmp_path):
    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    mmg = tmp_path / "landing" / "MMG"
    mmg.mkdir()
    (mmg / "CDR_MMG_1.csv").write_text("DOC_ID,LANG\n1,en\n2,fr\n")
    feeds["MMG"] = str(mmg)
    wh = str(tmp_path / "wh")

    out = {r.FILE_NAME: r for r in run_load(spark, feeds, wh, "2024-01-31 00:00:00", LoadOptions(cleanup="never")).collect()}
    assert out["CDR_OCC_03.csv"].MESSAGE.startswith("LOAD_ERROR: Wrong column count at data line 2")
    assert out["CDR_OCC_05.csv"].MESSAGE.startswith("LOAD_ERROR: Broken line (unbalanced quotes) at data line 6")
    assert out["CDR_OCC_09.csv"].MESSAGE == "WHITELIST_ERROR: Unknown columns: UNKNOWN_FIELD_1"
    assert out["CDR_OCC_11.csv"].MESSAGE.startswith("TRANSFORM_ERROR")  # key twice in the file
    assert out["CDR_MMG_1.csv"].MESSAGE.startswith("TRANSFORM_ERROR")
    ok = [r for r in out.values() if r.STATUS == "SUCCESS"]
    assert len(ok) == 16
    for r in ok:  # rows reconcile: parsed = staged = inserted + duplicates + rejected
        tmp, ins, rej = (int(x.split(":")[1]) for x in r.MESSAGE.split())
        assert r.ROWS_CSV == r.ROWS_DB == tmp == ins + r.DUPLICATES + rej
    detail = spark.read.parquet(f"{wh}/detail")
    n_detail = detail.count()
    assert n_detail == sum(r.INSERTED for r in ok)
    assert detail.groupBy("CHARGING_ID").count().where("count > 1").count() == 0
    assert "START_DAY" in detail.columns
    rejects = spark.read.parquet(f"{wh}/rejects").where("SOURCE_FILE = 'CDR_OCC_00.csv'").collect()
    assert len(rejects) == int(out["CDR_OCC_00.csv"].MESSAGE.split(":")[-1]) and all(r.REASONS for r in rejects)
    staged_files = {r.SOURCE_FILE for r in TB.read_staging(spark, f"{wh}/staging").select("SOURCE_FILE").distinct().collect()}
    assert "CDR_OCC_00.csv" in staged_files and "CDR_OCC_03.csv" not in staged_files

    # rerun: SUCCESS files are skipped; the failed ones are retried.  File 11
    # now succeeds: its repeated key was loaded by file 10 in the first run,
    # so the repeat is a harmless match (the reference's file-by-file rule).
    out2 = {r.FILE_NAME: r for r in run_load(spark, feeds, wh, "2024-01-31 01:00:00").collect()}
    assert set(out2) == {"CDR_OCC_03.csv", "CDR_OCC_05.csv", "CDR_OCC_09.csv", "CDR_OCC_11.csv", "CDR_MMG_1.csv"}
    assert out2["CDR_OCC_11.csv"].STATUS == "SUCCESS"
    assert [f for f, r in out2.items() if r.STATUS == "SUCCESS"] == ["CDR_OCC_11.csv"]
    assert spark.read.parquet(f"{wh}/detail").count() == n_detail + out2["CDR_OCC_11.csv"].INSERTED

    # a repaired file (new size) is loaded; on_success cleanup drops its staging partition
    p = os.path.join(feeds["OCC"], "CDR_OCC_03.csv")
    rows = open(p).read().split("\n")
    rows[1] = rows[2]  # replace the short row by a full one (its key now repeats inside the file)
    rows[1] = rows[1].replace('"CH', '"CHX', 1)
    open(p, "w").write("\n".join(rows))
    out3 = {r.FILE_NAME: r for r in run_load(spark, {"OCC": feeds["OCC"]}, wh, "2024-01-31 02:00:00").collect()}
    assert out3["CDR_OCC_03.csv"].STATUS == "SUCCESS"
    staged_after = {r.SOURCE_FILE for r in TB.read_staging(spark, f"{wh}/staging").select("SOURCE_FILE").distinct().collect()}
    assert "CDR_OCC_03.csv" not in staged_after

    cur = audit_latest(TB.read_audit_events(spark, f"{wh}/audit"))
    assert cur.count() == 22  # the repaired file has a new size: its own audit key
    assert cur.where(F.col("STATUS") == "SUCCESS").count() == 18


def test_staging_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "stg")
    a = spark.createDataFrame([("v1", "a.csv", "OCC"), ("v2", "b.csv", "OCC")], "X string, SOURCE_FILE string, SOURCE_DIR string")
    TB.write_staging(a, path)
    b = spark.createDataFrame([("v3", "a.csv", "OCC")], "X string, SOURCE_FILE string, SOURCE_DIR string")
    TB.write_staging(b, path)
    got = sorted((r.SOURCE_FILE, r.X) for r in TB.read_staging(spark, path).collect())
    assert got == [("a.csv", "v3"), ("b.csv", "v2")]
    TB.drop_staging_files(spark, path, spark.createDataFrame([("OCC", "b.csv")], "SOURCE_DIR string, SOURCE_FILE string"))
    assert [r.SOURCE_FILE for r in TB.read_staging(spark, path).collect()] == ["a.csv"]


def test_size_mismatch_is_download_error(spark, tmp_path):
    folder = tmp_path / "OCC"
    folder.mkdir()
    (folder / "CDR_OCC_1.csv").write_text("DATASOURCE,A_MSISDN\nOCC,1\n")
    listing = L.list_landing(spark, {"OCC": str(folder)})
    wrong = listing.withColumn("FILE_SIZE", F.col("FILE_SIZE") + 7)
    lines, scanned, _ = L.scan_lines(spark, wrong)
    bad = L.size_check(wrong, scanned).collect()
    assert len(bad) == 1 and bad[0].DETAIL.startswith("Size mismatch: local=")
    out = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "wh"), "2024-01-31 00:00:00", listing=wrong).collect()
    assert out[0].STATUS == "ERROR" and out[0].MESSAGE.startswith("DOWNLOAD_ERROR: Size mismatch")


def test_bucketed_key_table(spark, tmp_path):
    """Keys in a catalog table bucketed by key: loads append to it, and the
    merge's anti join reads it without reshuffling the key side."""
    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    opts = LoadOptions(cleanup="never", key_table="cdr_keys_test")
    run_load(spark, feeds, str(tmp_path / "wh"), "2024-01-31 00:00:00", opts)
    keys = spark.table("cdr_keys_test")
    assert keys.count() == spark.read.parquet(str(tmp_path / "wh" / "detail")).count()
    from cdrflow.operators import merge as MG
    from cdrflow.plans import registry as R

    ins, _ = MG.merge_insert_absent(R.valid(spark, SF001), keys, order_by=("SOURCE_LINE",))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ins._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan_lines_ = [l for l in plan.splitlines() if "cdr_keys_test" in l]
    assert scan_lines_ and "Bucketed: true" in scan_lines_[0]
    import re

    key_attr = re.search(r"\[(DEDUP_KEY#\d+)\]", scan_lines_[0]).group(1)
    # the (large) key side is read bucket by bucket, never reshuffled
    assert f"Exchange hashpartitioning({key_attr}" not in plan
    stats = TB.analyze(spark, "cdr_keys_test", ["DEDUP_KEY"])
    assert stats["rows"] == keys.count() and stats["bytes"] > 0


def test_sequential_mode_matches_file_by_file_order(spark, tmp_path):
    """Batch mode fails file 11 (its repeated key is new to the batch);
    file by file in name order, file 10 has already inserted that key, so
    the repeat is a harmless match and file 11 loads (reference behaviour)."""
    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    seq = {r.FILE_NAME: r for r in run_load(
        spark, feeds, str(tmp_path / "wh_seq"), "2024-01-31 00:00:00",
        LoadOptions(cleanup="never", sequential=True)).collect()}
    assert seq["CDR_OCC_11.csv"].STATUS == "SUCCESS"
    assert sum(r.STATUS == "SUCCESS" for r in seq.values()) == 17
    detail = spark.read.parquet(str(tmp_path / "wh_seq" / "detail"))
    assert detail.count() == sum(r.INSERTED for r in seq.values() if r.STATUS == "SUCCESS")
    assert detail.groupBy("CHARGING_ID").count().where("count > 1").count() == 0


def test_rerun_after_crash_before_audit(spark, tmp_path, monkeypatch):
    """A run lost after its detail append but before its audit rows is run
    again: the files are reprocessed, nothing is inserted twice."""
    import pytest

    from cdrflow.plans import batch_load as BL

    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    wh = str(tmp_path / "wh")
    real = BL.TB.append_audit
    calls = {"n": 0}

    def flaky(events, path):
        calls["n"] += 1
        if calls["n"] == 2:  # the final SUCCESS / ERROR events
            raise RuntimeError("driver lost")
        return real(events, path)

    monkeypatch.setattr(BL.TB, "append_audit", flaky)
    with pytest.raises(RuntimeError):
        run_load(spark, feeds, wh, "2024-01-31 00:00:00", LoadOptions(cleanup="never"))
    monkeypatch.setattr(BL.TB, "append_audit", real)
    n_first = spark.read.parquet(f"{wh}/detail").count()
    assert n_first > 0
    out = {r.FILE_NAME: r for r in run_load(spark, feeds, wh, "2024-01-31 01:00:00", LoadOptions(cleanup="never")).collect()}
    assert len(out) == 20  # every file reprocessed
    detail = spark.read.parquet(f"{wh}/detail")
    assert detail.groupBy("CHARGING_ID").count().where("count > 1").count() == 0  # nothing inserted twice
    # files loaded by the lost run insert nothing again; only file 11, which
    # failed fail_file then, now loads its new keys (its repeat is matched)
    assert {f: r.INSERTED for f, r in out.items() if r.STATUS == "SUCCESS" and r.INSERTED} == {
        "CDR_OCC_11.csv": detail.count() - n_first}


def test_wider_staging_layout_and_strict_mode(spark, tmp_path):
    """The typical OCC header (extra columns beyond the mapping) loads in
    dynamic mode when the staging layout has them, and fails in strict mode."""
    header = ["AGGREGATION_GROUP", "A_IMSI", "A_MSISDN_ORIG", "APN", "CALL_TYPE", "CHARGING_ID",
              "DATASOURCE", "EVENT_TYPE", "ORIG_START_TIME", "A_MSISDN", "SERVICE_ID", "SUBSCRIBER_TYPE",
              "ROAMING_TYPE", "PARTNER", "FILTER_CODE", "FLEX_FLD1", "FLEX_FLD2", "FLEX_FLD3"]
    row = ["g1", "i1", "o1", "internet", "data", "CHX1", "OCC", "click", "1704067200", "21600000001", "S", "PRE",
           "HOME", "P1", "F1", "x", "y", "z"]
    folder = tmp_path / "OCC"
    folder.mkdir()
    (folder / "CDR_OCC_T.csv").write_text(",".join(header) + "\n" + ",".join(row) + "\n")
    extra = {"OCC": ["AGGREGATION_GROUP", "A_IMSI", "A_MSISDN_ORIG"]}
    ok = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "wh1"), "2024-01-31 00:00:00",
                  LoadOptions(cleanup="never", staging_columns=extra)).first()
    assert ok.STATUS == "SUCCESS" and ok.MESSAGE == "TMP:1 DETAIL:1 REJECTED:0"
    staged = TB.read_staging(spark, str(tmp_path / "wh1" / "staging")).first()
    assert staged.AGGREGATION_GROUP == "g1" and staged.A_IMSI == "i1"
    strict = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "wh2"), "2024-01-31 00:00:00",
                      LoadOptions(cleanup="never", staging_columns=extra, whitelist_mode="strict")).first()
    assert strict.MESSAGE == "WHITELIST_ERROR: Unknown columns: AGGREGATION_GROUP, A_IMSI, A_MSISDN_ORIG"


def test_validate_sanitized_names_and_overflow_policy(spark, tmp_path):
    """D17: raw header names are whitelisted case-sensitively (reference);
    validate='sanitized' checks the storage names instead.  D9: an
    overflowing number fails the file by default, or becomes NULL."""
    header = ["datasource", "a_msisdn", "orig_start_time", "apn", "call_type", "event_type", "charging_id",
              "service_id", "subscriber_type", "roaming_type", "partner", "filter_code", "flex_fld1", "flex_fld2",
              "flex_fld3", "charge_amount"]
    row = ["OCC", "21600000001", "1704067200", "internet", "data", "click", "CHZ1", "S", "PRE", "HOME", "P1", "F1",
           "x", "y", "z", "1" * 25]
    folder = tmp_path / "OCC"
    folder.mkdir()
    (folder / "CDR_OCC_L.csv").write_text(",".join(header) + "\n" + ",".join(row) + "\n")
    raw = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "w1"), "2024-01-31 00:00:00",
                   LoadOptions(cleanup="never")).first()
    assert raw.MESSAGE.startswith("WHITELIST_ERROR: Unknown columns: datasource, a_msisdn")
    ovf = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "w2"), "2024-01-31 00:00:00",
                   LoadOptions(cleanup="never", validate="sanitized")).first()
    assert ovf.MESSAGE == "TRANSFORM_ERROR: numeric value out of range for the detail column"
    ok = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "w3"), "2024-01-31 00:00:00",
                  LoadOptions(cleanup="never", validate="sanitized", overflow="null")).first()
    assert ok.STATUS == "SUCCESS"
    d = spark.read.parquet(str(tmp_path / "w3" / "detail")).first()
    assert d.CHARGING_ID == "CHZ1" and d.CHARGE_AMOUNT is None


HEADER = ["DATASOURCE", "A_MSISDN", "ORIG_START_TIME", "APN", "CALL_TYPE", "EVENT_TYPE", "CHARGING_ID", "SERVICE_ID",
          "SUBSCRIBER_TYPE", "ROAMING_TYPE", "PARTNER", "FILTER_CODE", "FLEX_FLD1", "FLEX_FLD2", "FLEX_FLD3"]


def _row(key: str) -> str:
    return f"OCC,21600000001,1704067200,internet,data,click,{key},S,PRE,HOME,P1,F1,x,y,z"


def _file(folder, name: str, keys) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([",".join(HEADER), *map(_row, keys)]) + "\n")


def test_lines_do_not_depend_on_the_parallelism(spark, tmp_path):
    """The number of splits when the lines are read may differ from that when they were scanned."""
    folder = tmp_path / "OCC"
    _file(folder, "a.csv", [f"A{i}" for i in range(3000)])
    _file(folder, "b.csv", [f"B{i}" for i in range(50)])
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1024")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        lines, scanned, _ = L.scan_lines(spark, L.list_landing(spark, {"OCC": str(folder)}), scratch=str(tmp_path / "s"))
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "16")
        got = {}
        for r in lines.collect():
            got.setdefault(r.FILE_NAME, []).append((r.LINE_NO, r.LINE))
        assert [n for n, _ in sorted(got["a.csv"])] == list(range(1, 3002))
        assert sorted(got["a.csv"])[3000][1] == _row("A2999") and len(got["b.csv"]) == 51
        assert L.line_count_errors(lines, scanned).count() == 0
        lost = lines.where("LINE_NO <> 17")
        assert [r.DETAIL for r in L.line_count_errors(lost, scanned).orderBy("FILE_NAME").collect()] == [
            "Line count mismatch: numbered=3000 read=3001", "Line count mismatch: numbered=50 read=51"]
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_any_file_name_and_a_missing_file(spark, tmp_path):
    folder = tmp_path / "OCC"
    names = ["a b.csv", "a%20b.csv", "x[1].csv", "y{1,2}.csv", "p+q.csv", "é*?.csv", "h#1.csv"]
    for i, name in enumerate(names):
        _file(folder, name, [f"K{i}_{j}" for j in range(3)])
    _file(folder, "gone.csv", ["G1"])
    listing = spark.createDataFrame(L.list_landing(spark, {"OCC": str(folder)}).collect())
    (folder / "gone.csv").unlink()
    (folder / ".gone.csv.crc").unlink(missing_ok=True)
    out = {r.FILE_NAME: r for r in run_load(spark, {"OCC": str(folder)}, str(tmp_path / "wh"), "2024-01-31 00:00:00",
                                            LoadOptions(cleanup="never"), listing=listing).collect()}
    assert out.pop("gone.csv").MESSAGE.startswith("DOWNLOAD_ERROR: Size mismatch: local=0")
    assert {f: r.MESSAGE for f, r in out.items()} == {n: "TMP:3 DETAIL:3 REJECTED:0" for n in names}
    again = run_load(spark, {"OCC": str(folder)}, str(tmp_path / "wh"), "2024-01-31 01:00:00")
    assert again.count() == 0


def test_values_do_not_shift(spark, tmp_path):
    folder = tmp_path / "OCC"
    folder.mkdir()
    (folder / "q.csv").write_text('DATASOURCE,APN,PARTNER\nOCC, "x,y",P1\n"O"CC,"a""b",P2\n')
    run_load(spark, {"OCC": str(folder)}, str(tmp_path / "wh"), "2024-01-31 00:00:00", LoadOptions(cleanup="never"))
    rows = TB.read_staging(spark, str(tmp_path / "wh" / "staging")).orderBy("SOURCE_LINE").collect()
    assert [(r.DATASOURCE, r.APN, r.PARTNER) for r in rows] == [("OCC", "x,y", "P1"), ("OCC", 'a"b', "P2")]


def test_a_rejected_wide_file_changes_nothing_for_others(spark, tmp_path):
    from cdrflow.sources import csv_ingest as CI

    heads = spark.createDataFrame([("OCC", "ok.csv", "DATASOURCE,APN"), ("OCC", "wide.csv", ",".join(f"c{i}" for i in range(3000)))],
                                  "SOURCE_DIR string, FILE_NAME string, HEADER_LINE string")
    info = CI.header_info(heads, ["DATASOURCE", "APN"])
    assert CI.layouts(info) == [["DATASOURCE", "APN"]]
    assert [r[0] for r in info.where("FILE_NAME = 'wide.csv'").selectExpr("size(HEADER_COLS)").collect()] == [0]


def test_key_table_gives_the_outcomes_of_path_mode(spark, tmp_path):
    """With a key table that already has other keys: a file with a repeated key fails as a whole."""
    feeds = write_landing(spark, SF001, str(tmp_path / "landing"))
    _file(tmp_path / "before" / "OCC", "first.csv", ["ZZ1", "ZZ2"])
    out, rows = [], []
    for n, table in enumerate((None, "cdr_keys_outcomes")):
        wh, opts = str(tmp_path / f"wh{n}"), LoadOptions(cleanup="never", key_table=table, key_buckets=4)
        run_load(spark, {"OCC": str(tmp_path / "before" / "OCC")}, wh, "2024-01-30 00:00:00", opts)
        out.append(sorted((r.FILE_NAME, r.STATUS, r.MESSAGE, r.DUPLICATES) for r in run_load(spark, feeds, wh, "2024-01-31 00:00:00", opts).collect()))
        rows.append(sorted(r[0] for r in spark.read.parquet(f"{wh}/detail").select("CHARGING_ID").collect()))
    assert out[0] == out[1] and rows[0] == rows[1]
    assert [x[2] for x in out[1] if x[0] == "CDR_OCC_11.csv"][0].startswith("TRANSFORM_ERROR")


def test_a_run_lost_between_detail_and_keys(spark, tmp_path, monkeypatch):
    import pytest

    from cdrflow.plans import batch_load as BL

    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    opts = LoadOptions(cleanup="never", key_table="cdr_keys_crash", key_buckets=4)
    _file(folder, "a.csv", ["C1", "C2"])
    real = BL.TB.append_keys

    def lost(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(BL.TB, "append_keys", lost)
    with pytest.raises(RuntimeError):
        run_load(spark, {"OCC": str(folder)}, wh, "2024-01-31 00:00:00", opts)
    monkeypatch.setattr(BL.TB, "append_keys", real)
    assert not list((tmp_path / "wh" / "_runs").glob("*"))  # a failed run leaves no scratch
    row = run_load(spark, {"OCC": str(folder)}, wh, "2024-01-31 01:00:00", opts).first()
    assert row.MESSAGE == "TMP:2 DETAIL:0 REJECTED:0" and row.DUPLICATES == 2
    assert sorted(r[0] for r in spark.read.parquet(f"{wh}/detail").select("CHARGING_ID").collect()) == ["C1", "C2"]
    assert sorted(r[0] for r in spark.table("cdr_keys_crash").collect()) == ["C1", "C2"]


def test_audit_order_does_not_follow_the_clock(spark, tmp_path):
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    folder.mkdir()
    good = ",".join(HEADER) + "\n" + _row("T1") + "\n"
    (folder / "t.csv").write_text(good.replace("z\n", "\"\n"))  # same size, broken
    first = run_load(spark, {"OCC": str(folder)}, wh, "2024-01-31 00:00:10").first()
    assert first.STATUS == "ERROR"
    (folder / "t.csv").write_text(good)
    assert run_load(spark, {"OCC": str(folder)}, wh, "2024-01-31 00:00:00").first().STATUS == "SUCCESS"
    cur = audit_latest(TB.read_audit_events(spark, f"{wh}/audit")).collect()
    assert [(r.FILE_NAME, r.STATUS) for r in cur] == [("t.csv", "SUCCESS")]
    assert run_load(spark, {"OCC": str(folder)}, wh, "2024-01-31 00:00:05").count() == 0
