"""What a warehouse holds after reloads, lost runs and overlapping runs."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F
from test_files import HEADER, _file, _row

from cdrflow.operators import audit as A
from cdrflow.plans import batch_load as BL
from cdrflow.plans import fixtures as FX
from cdrflow.plans.batch_load import LoadOptions, clean_up, run_load
from cdrflow.sources import csv_ingest as CI
from cdrflow.sources import generations as G
from cdrflow.sources import landing as L
from cdrflow.sources import moves as MV
from cdrflow.sources import tables as TB
from cdrflow.sources import versions as V
from cdrflow.sources.lease import LeaseLost, RunInProgress, RunLease

KEEP = LoadOptions(cleanup="never")


def load(spark, folder, wh, hour, **options):
    out = run_load(spark, {"OCC": str(folder)}, wh, f"2024-01-31 {hour:02d}:00:00", LoadOptions(**{"cleanup": "never", **options}))
    return {r.FILE_NAME: r for r in out.collect()}


def staged(spark, wh):
    return sorted((r.SOURCE_FILE, r.CHARGING_ID) for r in TB.read_staging(spark, f"{wh}/staging").collect())


def keys(spark, wh):
    return sorted(r[0] for r in spark.read.schema("CHARGING_ID string").parquet(f"{wh}/detail").collect())


def test_a_version_without_rows_hides_the_one_before(spark, tmp_path):
    """v1 fails (key twice) and stays staged; v2 is header-only: nothing of v1 may load with it."""
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    _file(folder, "a.csv", ["K1", "K1", "K2"])
    _file(folder, "b.csv", ["B1"])
    assert load(spark, folder, wh, 0)["a.csv"].MESSAGE.startswith("TRANSFORM_ERROR: unique key violated")
    assert staged(spark, wh) == [("a.csv", "K1"), ("a.csv", "K1"), ("a.csv", "K2"), ("b.csv", "B1")]
    _file(folder, "a.csv", [])
    row = load(spark, folder, wh, 1, on_duplicate="keep_first")["a.csv"]
    assert (row.STATUS, row.MESSAGE, row.ROWS_CSV) == ("SUCCESS", "TMP:0 DETAIL:0 REJECTED:0", 0)
    assert keys(spark, wh) == ["B1"] and staged(spark, wh) == [("b.csv", "B1")]


def test_rejects_are_those_of_the_latest_version(spark, tmp_path):
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    _file(folder, "a.csv", ["K1"])
    bad = _row("K2").replace("21600000001", "")
    (folder / "a.csv").write_text("\n".join([",".join(HEADER), _row("K1"), bad]) + "\n")
    assert load(spark, folder, wh, 0)["a.csv"].MESSAGE == "TMP:2 DETAIL:1 REJECTED:1"
    assert [(r.SOURCE_LINE, r.SOURCE_FILE) for r in V.read(spark, f"{wh}/rejects").collect()] == [(3, "a.csv")]
    _file(folder, "a.csv", ["K1", "K2", "K3"])
    assert load(spark, folder, wh, 1)["a.csv"].MESSAGE == "TMP:3 DETAIL:2 REJECTED:0"
    assert V.read(spark, f"{wh}/rejects").count() == 0


def test_version_table_drop_and_vacuum(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("v1", "a", "D"), ("v2", "b", "D")], "X string, SOURCE_FILE string, SOURCE_DIR string")
    assert TB.read_staging(spark, path).count() == 0
    assert TB.write_staging(rows, path) == 0
    wider = spark.createDataFrame([("v3", 5, "b", "D")], "X string, Y int, SOURCE_FILE string, SOURCE_DIR string")
    assert TB.write_staging(wider, path) == 1
    got = TB.read_staging(spark, path)
    assert sorted((r.SOURCE_FILE, r.X, r.Y) for r in got.collect()) == [("a", "v1", None), ("b", "v3", 5)]
    drop = spark.createDataFrame([("a", "D")], "SOURCE_FILE string, SOURCE_DIR string")
    TB.drop_staging_files(spark, path, drop)
    assert sorted(os.listdir(f"{path}/rows")) == ["LOAD=1"]  # nothing of load 0 is current
    V.compact(spark, path)
    assert V.next_load(spark, path) == 2 and [r.X for r in TB.read_staging(spark, path).collect()] == ["v3"]
    TB.write_staging(rows.where("SOURCE_FILE = 'a'"), path)  # a dropped file may come again
    assert sorted(r.X for r in TB.read_staging(spark, path).collect()) == ["v1", "v3"]


@pytest.mark.parametrize("step", ["staging", "detail"])
def test_lost_rows_are_an_error_in_the_audit(spark, tmp_path, monkeypatch, step):
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    _file(folder, "a.csv", ["K1", "K2", "K3"])
    _file(folder, "b.csv", ["L1"])
    if step == "staging":
        real = CI.staging_rows
        monkeypatch.setattr(CI, "staging_rows", lambda *a: real(*a).where("SOURCE_FILE <> 'a.csv' OR SOURCE_LINE <> 3"))
        out = load(spark, folder, wh, 0)
        assert out["a.csv"].MESSAGE == "TRANSFORM_ERROR: Row count mismatch: parsed=3 staged=2"
        assert out["b.csv"].STATUS == "SUCCESS" and keys(spark, wh) == ["L1"]
    else:
        real = TB.append_detail
        monkeypatch.setattr(TB, "append_detail", lambda df, path, seen=None: real(df.where("CHARGING_ID <> 'K2'"), path, seen))
        out = load(spark, folder, wh, 0)
        assert {r.MESSAGE for r in out.values()} == {"TRANSFORM_ERROR: Row count mismatch after merge: merged=4 detail=3"}
        monkeypatch.undo()
        again = load(spark, folder, wh, 1)  # and the lost row comes with the next run
        assert again["a.csv"].MESSAGE == "TMP:3 DETAIL:1 REJECTED:0" and keys(spark, wh) == ["K1", "K2", "K3", "L1"]
    steps = {r.STEP: r.ROWS for r in spark.read.parquet(f"{wh}/progress").where("SEQ = 1").collect()}
    assert steps["parsed"] == 4 and steps["staged"] == (3 if step == "staging" else 4) and steps["detail"] == (1 if step == "staging" else 3)


def test_one_run_at_a_time(spark, tmp_path):
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    _file(folder, "a.csv", ["K1"])
    with RunLease(spark, f"{wh}/_lease", 600) as first:
        with pytest.raises(RunInProgress):
            load(spark, folder, wh, 0)
        with pytest.raises(RunInProgress):
            clean_up(spark, wh, "2024-01-31 00:00:00")
        first.check()
    assert load(spark, folder, wh, 1)["a.csv"].STATUS == "SUCCESS"


def test_a_stream_refuses_beside_a_run(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from cdrflow.streaming.incremental import start_incremental

    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    _file(folder, "a.csv", ["K1"])
    with RunLease(spark, f"{wh}/_lease", 600):
        q = start_incremental(spark, {"OCC": str(folder)}, wh, str(tmp_path / "cp"))
        with pytest.raises(StreamingQueryException, match="RunInProgress"):
            q.awaitTermination()
    start_incremental(spark, {"OCC": str(folder)}, wh, str(tmp_path / "cp")).awaitTermination()
    assert keys(spark, wh) == ["K1"]


def test_an_expired_lease_is_taken_over(spark, tmp_path):
    folder, now = str(tmp_path / "lease"), [1000.0]
    dead = RunLease(spark, folder, 60, clock=lambda: now[0]).acquire()
    now[0] += 30
    dead.renew()
    now[0] += 50  # past the first expiry, not past the renewed one
    with pytest.raises(RunInProgress):
        RunLease(spark, folder, 60, clock=lambda: now[0]).acquire()
    now[0] += 11
    heir = RunLease(spark, folder, 60, clock=lambda: now[0]).acquire()
    heir.check()
    with pytest.raises(LeaseLost):
        dead.check()
    dead.release()  # a late release of the lost run changes nothing
    with pytest.raises(RunInProgress):
        RunLease(spark, folder, 60, clock=lambda: now[0]).acquire()
    heir.release()
    RunLease(spark, folder, 60, clock=lambda: now[0]).acquire()


def test_a_lease_is_renewed_while_the_run_goes_on(spark, tmp_path):
    folder = str(tmp_path / "lease")
    with RunLease(spark, folder, 1.5):
        time.sleep(3)
        with pytest.raises(RunInProgress):
            RunLease(spark, folder, 1.5).acquire()


def names(folder):
    return sorted(n for n in os.listdir(folder) if n.endswith(".csv")) if os.path.isdir(folder) else []


def test_files_go_to_out_and_err(spark, tmp_path, monkeypatch):
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    routes = MV.Routes(str(tmp_path / "OUT"), str(tmp_path / "ERR"))
    _file(folder, "good.csv", ["K1"])
    _file(folder, "sp ace%.csv", ["K9"])
    _file(folder, "bad.csv", ["K2", "K2"])
    real = MV.replay
    calls = []

    def lost(*a):
        calls.append(1)
        if len(calls) == 2:  # after the audit, before the first move
            raise RuntimeError("driver lost")
        return real(*a)

    monkeypatch.setattr(BL.MV, "replay", lost)
    with pytest.raises(RuntimeError):
        load(spark, folder, wh, 0, routes=routes)
    monkeypatch.setattr(BL.MV, "replay", real)
    assert names(folder) == ["bad.csv", "good.csv", "sp ace%.csv"]
    _file(folder, "new.csv", ["K3"])
    time.sleep(1.1)
    _file(folder, "good.csv", ["K1", "K4"])  # another file of the name has landed: it stays until it is loaded
    out = load(spark, folder, wh, 1, routes=routes)
    assert set(out) == {"good.csv", "new.csv"} and out["good.csv"].MESSAGE == "TMP:2 DETAIL:1 REJECTED:0"
    assert names(folder) == []
    assert names(tmp_path / "OUT" / "OCC") == ["good.csv", "new.csv", "sp ace%.csv"] and names(tmp_path / "ERR" / "OCC") == ["bad.csv"]
    assert keys(spark, wh) == ["K1", "K3", "K4", "K9"]


def test_a_journal_without_its_audit_is_dropped(spark, tmp_path):
    folder = tmp_path / "OCC"
    _file(folder, "a.csv", ["K1"])
    files = L.list_landing(spark, {"OCC": str(folder)}).withColumn("STATUS", F.lit("SUCCESS"))
    moves = MV.intended(files, MV.Routes(str(tmp_path / "OUT"), str(tmp_path / "ERR")))
    MV.write_journal(moves, str(tmp_path / "j"), 7)
    events = A.audit_event(files, "SUCCESS", FX.ntz("2024-01-31 00:00:00"), seq=6)
    assert MV.replay(spark, str(tmp_path / "j"), events) == 0 and names(folder) == ["a.csv"]
    assert not [n for n in os.listdir(tmp_path / "j") if n.startswith("seq=")]


@pytest.mark.parametrize("lost_at", ["write", "pointer", "delete"])
def test_a_replacement_lost_at_any_step_leaves_a_table(spark, tmp_path, monkeypatch, lost_at):
    path = str(tmp_path / "audit")
    rows = spark.createDataFrame([(i,) for i in range(6)], "X int")
    G.append(rows, path)
    G.append(rows, path)

    def stop(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        if lost_at == "write":
            m.setattr(G.FS, "delete_path", stop)
        elif lost_at == "pointer":
            m.setattr(G.FS, "create_exclusive", stop)
        else:
            real, calls = G.FS.delete_path, []
            m.setattr(G.FS, "delete_path", lambda *a: real(*a) if calls.append(1) or len(calls) == 1 else stop())
        with pytest.raises(RuntimeError):
            G.replace(G.read(spark, path, "X int").where("X < 2"), path)
    assert G.read(spark, path, "X int").count() == (4 if lost_at == "delete" else 12)
    G.append(rows.where("X = 5"), path)
    G.replace(G.read(spark, path, "X int").where("X <> 1"), path)
    n = G.read(spark, path, "X int").count()
    assert n == (3 if lost_at == "delete" else 11)
    assert len([x for x in os.listdir(tmp_path) if x.startswith("audit.g")]) == 1 and not os.path.exists(path)


def test_clean_up_after_a_load_that_left_nothing_staged(spark, tmp_path):
    folder, wh = tmp_path / "OCC", str(tmp_path / "wh")
    _file(folder, "a.csv", ["K1"])
    load(spark, folder, wh, 0, cleanup="on_success")
    clean_up(spark, wh, "2024-01-31 10:00:00")
    assert TB.read_audit_events(spark, f"{wh}/audit").count() == 2
    clean_up(spark, wh, "2024-07-31 10:00:00")  # all of the audit is older than 90 days
    assert TB.read_audit_events(spark, f"{wh}/audit").count() == 0
    assert load(spark, folder, wh, 2)["a.csv"].DUPLICATES == 1


@pytest.mark.parametrize("mark", [b"", b"\xef\xbb\xbf"])
@pytest.mark.parametrize("end", [b"\n", b""])
def test_every_byte_is_accounted_for(spark, tmp_path, mark, end):
    folder = tmp_path / "OCC"
    folder.mkdir()
    (folder / "a.csv").write_bytes(mark + b"DATASOURCE,A_MSISDN\nOCC,1" + end)
    listing = L.list_landing(spark, {"OCC": str(folder)})
    _, scanned, _ = L.scan_lines(spark, listing)
    assert L.size_check(listing, scanned).count() == 0
    short = listing.withColumn("FILE_SIZE", F.col("FILE_SIZE") + (3 if not mark else 1))
    _, scanned, _ = L.scan_lines(spark, short)
    assert L.size_check(short, scanned).count() == (1 if end or not mark else 0) or mark


def test_the_parse_plan_does_not_grow_with_the_layouts(spark):
    columns = [f"C{i}" for i in range(12)]

    def ingest(n):
        files = [f"f{i:04d}" for i in range(n)]
        order = {f: columns[i % 12 :] + columns[: i % 12] if i < 12 else [c for c in columns if hash((i, c)) % 3] for i, f in enumerate(files)}
        rows = [("D", f, 1, ",".join(h)) for f, h in order.items()] + [("D", f, 2, ",".join(f"{f}-{c}" for c in h)) for f, h in order.items()]
        lines = spark.createDataFrame(rows, "SOURCE_DIR string, FILE_NAME string, LINE_NO int, LINE string")
        info = CI.header_info(CI.file_headers(lines), columns)
        return order, CI.parse_lines(lines, info, columns)

    order, parsed = ingest(500)
    for r in parsed.collect():
        assert r.LINE_ERROR is None
        assert {c: r[c] for c in columns if r[c]} == {c: f"{r.FILE_NAME}-{c}" for c in order[r.FILE_NAME]}

    def size(df):
        return len(df._jdf.queryExecution().optimizedPlan().expressions().toString()), df._jdf.queryExecution().optimizedPlan().toString().count("CASE")

    assert size(parsed) == size(ingest(3)[1])


def test_wide_rows_are_in_no_aggregate_of_the_merge(spark, monkeypatch):
    from conftest import SF001

    from cdrflow.plans import registry as R

    inserted, _ = R.merged(spark, SF001)
    plan = inserted._jdf.queryExecution().executedPlan().toString()
    aggregates = [x for x in plan.splitlines() if "Aggregate(" in x]
    assert aggregates and not [x for x in aggregates if "FLEX_FLD2" in x or "min_by" in x]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from cdrflow.sources import shared_fs as FS

    def session(master, **conf):
        path = SimpleNamespace(toUri=lambda: SimpleNamespace(getScheme=lambda: conf["dir"].split(":")[0]))
        fs = SimpleNamespace(makeQualified=lambda p: p)
        jvm = SimpleNamespace(org=SimpleNamespace(apache=SimpleNamespace(hadoop=SimpleNamespace(fs=SimpleNamespace(
            Path=lambda p: SimpleNamespace(getFileSystem=lambda c: SimpleNamespace(makeQualified=lambda q: path)))))))
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, _jvm=jvm, _jsc=SimpleNamespace(hadoopConfiguration=lambda: fs))
        get = {"spark.checkpoint.dir": conf.get("shared"), "spark.sql.warehouse.dir": conf["dir"]}.get
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: get(k) or d), sparkContext=context)

    assert FS.shared_root(session("local[4]", dir="file:/w/")) == "file:/w"
    assert FS.shared_root(session("yarn", dir="hdfs://n/w")) == "hdfs://n/w"
    assert FS.shared_root(session("yarn", dir="file:/w", shared="hdfs://n/c/")) == "hdfs://n/c"
    for master in ("yarn", "local-cluster[3,2,3000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            FS.shared_root(session(master, dir="file:/w"))
