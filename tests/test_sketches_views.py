"""Merged daily sketches against exact statistics, and the views by name against their DataFrame form."""

from __future__ import annotations

import random

from conftest import SF001
from pyspark.sql import functions as F

from cdrflow.operators import sketches as SK
from cdrflow.plans import fixtures as FX
from cdrflow.plans import monitor as M
from cdrflow.plans import registry as R
from cdrflow.plans.views import register_views
from cdrflow.sources import tables as TB


def test_merged_days_equal_one_sketch_within_the_bounds(spark):
    rnd = random.Random(1)
    rows = [(f"2024-01-{1 + rnd.randrange(9):02d} 10:00:00", rnd.choice([None, "x", f"u{rnd.randrange(5000)}"]), rnd.lognormvariate(0, 2) if i % 7 else None)
            for i in range(30_000)]
    df = spark.createDataFrame(rows, "T string, U string, V double").select(F.col("T").cast("timestamp_ntz").alias("START_DATE"), "U", "V")
    days = SK.daily_sketches(df, ["U", "V"])
    assert days.count() == 18
    found = SK.checked_statistics(df, SK.window_statistics(days, "2024-01-02", "2024-01-05"), ["U", "V"], "2024-01-02", "2024-01-05")
    got = {r.COLUMN_NAME: r for r in found.collect()}
    inside = [(u, v) for t, u, v in rows if "2024-01-02" <= t[:10] <= "2024-01-05"]
    for c, i in (("U", 0), ("V", 1)):
        values = [x[i] for x in inside]
        assert (got[c].ROW_COUNT, got[c].NULL_COUNT) == (len(values), values.count(None))
        assert got[c].DISTINCT_EXACT == len(set(values) - {None}) and got[c].DISTINCT_OK
    assert got["V"].MEDIAN_OK and got["V"].P95_OK and got["U"].MEDIAN_OK is None
    none = SK.window_statistics(SK.daily_sketches(df.where("V > 1e9"), ["U", "V"]), "2024-01-01", "2024-01-09")
    assert none.count() == 0
    empty_column = SK.window_statistics(SK.daily_sketches(df.withColumn("V", F.lit(None).cast("double")), ["V"]), "2024-01-01", "2024-01-09").first()
    assert empty_column.MEDIAN_ESTIMATE is None and empty_column.DISTINCT_ESTIMATE == 0


def test_a_wrong_estimate_is_reported(spark):
    df = spark.range(1000).selectExpr("timestamp_ntz'2024-01-03 00:00:00' AS START_DATE", "cast(id AS double) AS V")
    stats = SK.window_statistics(SK.daily_sketches(df, ["V"]), "2024-01-01", "2024-01-09")
    wrong = stats.withColumns({"DISTINCT_ESTIMATE": F.lit(1100).cast("bigint"), "MEDIAN_ESTIMATE": F.lit(600.0)})
    r = SK.checked_statistics(df, wrong, ["V"], "2024-01-01", "2024-01-09").first()
    assert not r.DISTINCT_OK and not r.MEDIAN_OK and r.P95_OK


def test_views_by_name_equal_the_functions(spark, tmp_path):
    detail_path = str(tmp_path / "detail")
    TB.append_detail(R.detail(spark, SF001).drop("SOURCE_FILE", "SOURCE_DIR"), detail_path)
    detail = spark.read.parquet(detail_path)
    audit, occ, mmg = R.audit(spark, SF001), FX.cdr_raw(spark, SF001), FX.staging_mmg(spark, SF001)
    register_views(spark, audit, occ, mmg, detail)
    for as_of in ("2024-01-31 00:00:00", "2024-01-20 12:00:00"):
        got = spark.sql(f"SELECT * FROM cdr_dashboard(TIMESTAMP_NTZ'{as_of}')")
        assert got.collect() == M.v_dashboard(audit, occ, mmg, detail, as_of).collect()
    week = spark.sql("SELECT * FROM cdr_recent(TIMESTAMP_NTZ'2024-01-31 00:00:00', 7)")
    assert "PartitionFilters: [isnotnull(START_DAY" in (plan := week._jdf.queryExecution().executedPlan().toString()) or "START_DAY" in plan.split("PartitionFilters: [")[1][:80]
    assert sorted(week.collect(), key=repr) == sorted(M.v_recent(detail, "2024-01-31 00:00:00", 7).collect(), key=repr)
    assert spark.sql("SELECT * FROM cdr_recent(TIMESTAMP_NTZ'2024-01-31 00:00:00')").count() == M.v_recent(detail, "2024-01-31 00:00:00").count()
    counted = M.table_volume(detail).first()
    import glob
    import os

    files = glob.glob(f"{detail_path}/*/*.parquet")
    assert (counted.FILES, counted.BYTES) == (len(files), sum(map(os.path.getsize, files)))


def test_recent_rows_are_sorted_only_where_they_are_shown(spark, tmp_path):
    detail_path = str(tmp_path / "detail")
    TB.append_detail(R.detail(spark, SF001).drop("SOURCE_FILE", "SOURCE_DIR"), detail_path)
    recent = M.v_recent(spark.read.parquet(detail_path), "2024-01-31 00:00:00")

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "Sort" not in plan(recent) and "Exchange" not in plan(recent)
    assert "TakeOrderedAndProject" in plan(M.newest_first(recent, 20))
    rows = sorted(recent.collect(), key=lambda r: r.CHARGING_ID)
    rows.sort(key=lambda r: r.START_DATE, reverse=True)  # stable: equal times stay by key
    assert M.newest_first(recent, 20).collect() == rows[:20]
    assert M.newest_first(recent).collect() == rows and len(rows) > 20


def test_equal_and_missing_times_have_an_order(spark):
    df = spark.sql(
        "SELECT * FROM VALUES ('b', timestamp_ntz'2024-01-02 00:00:00'), ('a', timestamp_ntz'2024-01-02 00:00:00'), "
        "('c', NULL), (NULL, timestamp_ntz'2024-01-02 00:00:00'), ('d', timestamp_ntz'2024-01-03 00:00:00') AS t(CHARGING_ID, START_DATE)"
    )
    assert [r.CHARGING_ID for r in M.newest_first(df).collect()] == ["d", "a", "b", None, "c"]
    assert M.newest_first(df.where("false"), 5).count() == 0
