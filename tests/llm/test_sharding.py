from collections import Counter

import pytest

from cdrflow.llm import sharding as S

SHARDS = [f"s{i}" for i in range(7)]


def test_shares_differ_by_one_slot_and_few_slots_move():
    full = S.fill_table(SHARDS, 1009)
    counts = Counter(full)
    assert set(full) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = S.fill_table(SHARDS[:-1], 1009)
    moved = sum(a != b for a, b in zip(full, fewer) if a != 6)
    assert moved < 0.25 * 1009


@pytest.mark.parametrize("shards,slots", [([], 7), (["a", "a"], 7), (["a", "b"], 8), (["a"] * 1, 10**7 + 19)])
def test_bad_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        S.fill_table(shards, slots)


def test_every_row_is_placed(spark):
    rows = [(1, "x", 9, "a"), (1, "x", 9, "a"), (None, "y", 8, "b"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, slot string, shard int, text string")
    out = S.assign_shards(df, "doc_id", SHARDS, 1009).collect()
    table = S.fill_table(SHARDS, 1009)
    assert len(out) == 4
    for r in out:
        slot = S._number("" if r.doc_id is None else str(r.doc_id)) % 1009
        assert (r.slot, r.shard) == (slot, SHARDS[table[slot]])
    assert S.assign_shards(df.limit(0), "doc_id", SHARDS, 1009).count() == 0


def test_plan_neither_shuffles_nor_runs_python(spark):
    df = S.assign_shards(spark.range(10).withColumnRenamed("id", "doc_id"), "doc_id", SHARDS, 1009)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan
