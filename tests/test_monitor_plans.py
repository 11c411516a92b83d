"""Monitoring values of FIXTURES.md B2 (sf0.001) and plan properties."""

from __future__ import annotations

from conftest import SF001

from pyspark.sql import functions as F

from cdrflow.operators import audit as A
from cdrflow.plans import fixtures as FX
from cdrflow.plans import monitor as M
from cdrflow.plans import registry as R


def test_success_rate_values(spark):
    rows = {r.SOURCE_DIR: r for r in M.m_success_rate(FX.load_audit(spark, SF001), FX.AS_OF).collect()}
    assert (rows["MMG"].TOTAL_FILES, rows["MMG"].SUCCESS_COUNT, rows["MMG"].SUCCESS_RATE_PCT) == (119, 43, 36.13)
    assert (rows["OCC"].TOTAL_FILES, rows["OCC"].SUCCESS_COUNT, rows["OCC"].SUCCESS_RATE_PCT) == (239, 70, 29.29)


def test_status_today_and_classes(spark):
    a = FX.load_audit(spark, SF001)
    st = {r.STATUS: r for r in M.m_status_today(a, FX.TODAY).collect()}
    assert (st["DOWNLOADED"].FILE_COUNT, st["ERROR"].FILE_COUNT, st["SUCCESS"].FILE_COUNT) == (17, 20, 22)
    assert st["SUCCESS"].TOTAL_ROWS == 4976
    cls = {r.ERROR_CLASS: r.FILE_COUNT for r in A.error_classes(a).collect()}
    assert cls == {"CSV_INVALID": 120, "LOAD_ERROR": 124, "TRANSFORM_ERROR": 130, "WHITELIST_ERROR": 119}


def test_reject_rate_inputs(spark):
    a = FX.load_audit(spark, SF001)
    p = A.parse_success_message(a.where(a.LOAD_TS >= FX.ntz("2024-01-24 00:00:00")))
    from pyspark.sql import functions as F

    r = p.agg(F.count("TMP_ROWS").alias("files"), F.sum("REJECTED_ROWS").alias("rej")).first()
    assert (r.files, r.rej) == (113, 2717)
    assert p.where("TMP_ROWS = 0").count() == 4
    top = M.m_reject_rate(a, FX.AS_OF).collect()
    assert len(top) == 20
    assert top[-1].REJECT_RATE_PCT is None or top[0].REJECT_RATE_PCT >= top[-1].REJECT_RATE_PCT


def test_dashboard_one_pass_per_table(spark):
    d = R.QUERIES["v_dashboard"](spark, SF001)
    plan = d._jdf.queryExecution().executedPlan().toString()
    # four source tables -> four parquet scans (orders, events x2 for staging
    # and detail keys + documents), never one scan per scalar
    assert plan.count("FileScan parquet") <= 5
    r = d.first()
    assert r.TMP_OCC_ROWS == 1000 and r.DETAIL_OCC_TOTAL == 742


def test_day_filter_reaches_detail_scan(spark, tmp_path):
    """Detail written day-partitioned: a day window prunes partitions and the
    range predicate is pushed to the parquet scan."""
    from cdrflow.sources import tables as TB

    path = str(tmp_path / "detail")
    TB.append_detail(R.detail(spark, SF001).drop("SOURCE_FILE", "SOURCE_DIR"), path)
    det = spark.read.parquet(path)
    q = M.m_event_mix(det, FX.TODAY)
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(START_DAY" in plan and ">= 2024-01-30)" in plan
    assert "PushedFilters: [GreaterThanOrEqual(START_DATE,2024-01-30T00:00), LessThan(START_DATE,2024-01-31" in plan
    # column pruning: only the columns the query needs are read
    scan = [l for l in plan.splitlines() if "ReadSchema" in l][0]
    assert "A_MSISDN" not in scan and "EVENT_TYPE" in scan
    assert q.count() > 0


def test_orphans_not_in_with_null_vs_anti_join(spark):
    """D21: NOT IN over a list holding a NULL keeps nothing; the anti join
    used by ``orphans`` still finds the orphan files."""
    from cdrflow.operators import maintain as MT

    stg = spark.createDataFrame(
        [("OCC", "a.csv", "2024-01-01 00:00:00"), ("OCC", "b.csv", "2024-01-01 00:00:00")],
        "SOURCE_DIR string, SOURCE_FILE string, LOAD_TS string",
    ).withColumn("LOAD_TS", F.col("LOAD_TS").cast("timestamp_ntz"))
    aud = spark.createDataFrame(
        [("OCC", "a.csv", "SUCCESS", "2024-01-30 12:00:00"), ("OCC", None, "SUCCESS", "2024-01-30 12:00:00")],
        "SOURCE_DIR string, FILE_NAME string, STATUS string, LOAD_TS string",
    ).withColumn("LOAD_TS", F.col("LOAD_TS").cast("timestamp_ntz"))
    stg.createOrReplaceTempView("stg_d21")
    aud.createOrReplaceTempView("aud_d21")
    literal = spark.sql(
        "SELECT * FROM stg_d21 WHERE SOURCE_FILE NOT IN (SELECT FILE_NAME FROM aud_d21 WHERE STATUS = 'SUCCESS')"
    )
    assert literal.count() == 0
    keep, drop = MT.orphans(stg, aud, FX.AS_OF, 24)
    assert [r.SOURCE_FILE for r in drop.collect()] == ["b.csv"]
    assert [r.SOURCE_FILE for r in keep.collect()] == ["a.csv"]


def test_audit_message_cut_and_latest(spark):
    ev = spark.createDataFrame(
        [("OCC", "f.csv", 10, 0, "x"), ("OCC", "f.csv", 10, 1, "y" * 5000)],
        "SOURCE_DIR string, FILE_NAME string, FILE_SIZE bigint, SEQ int, M string",
    )
    events = A.audit_event(ev, "ERROR", FX.ntz(FX.AS_OF), A.error_message("LOAD_ERROR", F.col("M")), seq=F.col("SEQ"))
    cur = A.audit_latest(events).first()
    assert len(cur.MESSAGE) == 4000 and cur.MESSAGE.startswith("LOAD_ERROR: yyy")


def test_flag_filters_read_the_computed_column(spark):
    """The valid/rejected filter runs on the projected REJECT_REASONS, not on
    a re-inlined copy of every check."""
    plan = R.valid(spark, SF001)._jdf.queryExecution().optimizedPlan().toString()
    filters = [l for l in plan.splitlines() if "Filter" in l]
    assert any("size(REJECT_REASONS#" in l for l in filters)
    assert not any("REQUIRED_BLANK" in l for l in filters)


def test_staging_counts_empty_feed_and_retention(spark):
    occ = FX.cdr_raw(spark, SF001)
    empty = spark.createDataFrame([], "SOURCE_FILE string, SOURCE_DIR string, LOAD_TS timestamp_ntz")
    rows = {r.TABLE_NAME: (r.ROW_COUNT, r.FILE_COUNT) for r in M.m_staging_counts({"RA_T_TMP_OCC": occ, "RA_T_TMP_MMG": empty}).collect()}
    assert rows == {"RA_T_TMP_OCC": (1000, 20), "RA_T_TMP_MMG": (0, 0)}

    from cdrflow.operators import maintain as MT

    a = FX.load_audit(spark, SF001)
    keep, drop = MT.retain(a, FX.AS_OF, days=7)
    assert keep.count() + drop.count() == a.count() and drop.count() > 0
    assert drop.where(F.col("LOAD_TS") >= FX.ntz("2024-01-24 00:00:00")).count() == 0
    keep90, drop90 = MT.retain(a, FX.AS_OF, days=90)
    assert drop90.count() == 0


def test_a_file_filter_before_the_flags_prunes(spark, tmp_path):
    from cdrflow.operators import transform as TR
    from cdrflow.sources import tables as TB

    TB.write_staging(FX.cdr_raw(spark, SF001), str(tmp_path / "staging"))
    rows = TB.read_staging(spark, str(tmp_path / "staging")).where(F.col("SOURCE_FILE") == "CDR_OCC_04.csv")
    one = TR.valid_rows(TR.flag(rows, keep=["SOURCE_LINE"]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(SOURCE_FILE,CDR_OCC_04.csv)" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert one.count() > 0


def test_reconciliation_can_fail(spark):
    """A row lost between any two steps, or staged twice, shows."""
    from cdrflow.operators import transform as TR
    from cdrflow.plans.registry_ingest import reconcile

    staged = FX.cdr_raw(spark, SF001).where("SOURCE_FILE = 'CDR_OCC_04.csv'")
    flagged = TR.flag(staged, keep=["SOURCE_LINE"]).cache()
    n = staged.count()
    lines = spark.range(n + 1).selectExpr("'OCC' AS SOURCE_DIR", "'CDR_OCC_04.csv' AS FILE_NAME", "id + 1 AS LINE_NO", "'x' AS LINE")
    routing = spark.createDataFrame([("OCC", "CDR_OCC_04.csv", "SUCCESS", n)], "SOURCE_DIR string, FILE_NAME string, STATUS string, ROWS_CSV bigint")
    inserted = TR.valid_rows(flagged).where("SOURCE_LINE % 3 = 0")

    def result(**change):
        frames = {"lines": lines, "routing": routing, "staged": staged, "flagged": flagged, "inserted": inserted} | change
        return reconcile(**frames).first()

    good = result()
    assert good.RECONCILED and good.DUPLICATES > 0 and good.REJECTED > 0
    assert not result(lines=lines.limit(n)).RECONCILED
    assert not result(staged=staged.where("SOURCE_LINE <> 24")).RECONCILED
    assert not result(flagged=flagged.where("SOURCE_LINE <> 44")).RECONCILED
    assert not result(inserted=inserted.union(inserted)).RECONCILED


def test_extra_functions_of_every_kind(spark):
    """The mapping's user function sees number and timestamp text too."""
    from cdrflow.mapping import ColumnSpec
    from cdrflow.operators import transform as TR

    mapping = (
        ColumnSpec("T", "START_DATE", True, "timestamp", "trim", extra=lambda c: F.replace(c, F.lit("s"), F.lit(""))),
        ColumnSpec("N", "N", False, "number", precision=5, scale=1, extra=lambda c: F.replace(c, F.lit(","), F.lit("."))),
        ColumnSpec("K", "K", True, "string", "trim", 10, extra=lambda c: F.nullif(F.lower(c), F.lit("none"))),
    )
    df = spark.createDataFrame([("1704067200s", "1,5", "AB"), ("1704067200", "123456,0", "none"), ("x", "2", "C")], "T string, N string, K string")
    df = df.withColumns({"SOURCE_FILE": F.lit("f"), "SOURCE_DIR": F.lit("d")})
    flagged = TR.flag(df, mapping, ("K",))
    rows = flagged.collect()
    assert [str(r.START_DATE) for r in rows] == ["2024-01-01 00:00:00", "2024-01-01 00:00:00", "None"]
    assert [r.N and float(r.N) for r in rows] == [1.5, None, 2.0] and [r.K for r in rows] == ["ab", None, "c"]
    assert [list(r.CONSTRAINT_VIOLATIONS) for r in rows] == [[], ["N"], []]
    found = {r.COLUMN_NAME: r.NULLS for r in TR.null_violations(flagged, mapping).collect()}
    assert found == {"START_DATE": 1, "K": 1}


def test_retention_and_orphans_on_storage(spark, tmp_path):
    from cdrflow.plans.batch_load import clean_up
    from cdrflow.sources import tables as TB

    wh = str(tmp_path / "wh")
    files = spark.createDataFrame([("OCC", f"{x}.csv", 1) for x in "abc"], "SOURCE_DIR string, FILE_NAME string, FILE_SIZE bigint")
    for n, (name, ts) in enumerate([("a", "2023-09-01 00:00:00"), ("b", "2024-01-30 12:00:00"), ("c", "2024-01-01 00:00:00")]):
        status = "ERROR" if name == "c" else "SUCCESS"
        TB.append_audit(A.audit_event(files.where(F.col("FILE_NAME") == f"{name}.csv"), status, FX.ntz(ts), seq=n), f"{wh}/audit")
    rows = [("v", "a.csv", "OCC", "2024-01-01"), ("v", "b.csv", "OCC", "2024-01-01"), ("v", "c.csv", "OCC", "2024-01-30 23:00:00")]
    stage = spark.createDataFrame(rows, "X string, SOURCE_FILE string, SOURCE_DIR string, T string")
    TB.write_staging(stage.select("X", "SOURCE_FILE", "SOURCE_DIR", F.col("T").cast("timestamp_ntz").alias("LOAD_TS")), f"{wh}/staging")
    clean_up(spark, wh, "2024-01-31 00:00:00", retention_days=90, orphan_hours=24)
    assert sorted(r.SOURCE_FILE for r in TB.read_staging(spark, f"{wh}/staging").collect()) == ["b.csv", "c.csv"]
    assert sorted(r.FILE_NAME for r in TB.read_audit_events(spark, f"{wh}/audit").collect()) == ["b.csv", "c.csv"]
