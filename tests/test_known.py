"""Known ids by bitmaps against the plain anti join."""

import pytest

from threadloom.operators import joins, known


@pytest.mark.parametrize("slot_bits", [16, 40])
def test_equals_the_anti_join(spark, tmp_path, slot_bits):
    history = spark.createDataFrame([(f"k{n}",) for n in range(0, 6000, 2)] + [(None,)], "id string")
    incoming = spark.createDataFrame([(f"k{n}", n) for n in range(500)] + [("k1", -1), ("k2", -2), (None, -3)], "id string, v int")
    for run in ("a", "b", "b"):
        known.add_known(history.where("id < 'k3' or id is null") if run == "a" else history.where("id >= 'k3'"), str(tmp_path), "id", run, slot_bits)
    bitmaps = known.read_bitmaps(spark, str(tmp_path))
    got = known.not_known(incoming, bitmaps, history, "id", slot_bits)
    want = joins.not_known(incoming, history, "id")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    new, hits = known.split_by_bitmap(incoming, bitmaps, "id", slot_bits)
    # Every known id is a hit; with enough slots, hardly any other is.
    assert new.count() + hits.count() == 503
    assert 251 <= hits.count() <= (251 + 30 if slot_bits == 16 else 251)
    before = sorted(map(str, bitmaps.collect()))
    known.compact(spark, str(tmp_path), "all")
    assert sorted(map(str, known.read_bitmaps(spark, str(tmp_path)).collect())) == before and [p.name for p in tmp_path.glob("run=*")] == ["run=all"]


def test_the_history_is_not_read_without_a_hit(spark, tmp_path):
    history = spark.range(10).selectExpr("id as k", "raise_error('read') as x")
    known.add_known(spark.range(10).selectExpr("id as k"), str(tmp_path), "k", "a")
    bitmaps = known.read_bitmaps(spark, str(tmp_path))
    fresh = known.not_known(spark.range(100, 200).selectExpr("id as k"), bitmaps, history.where("x is not null"), "k")
    assert fresh.count() == 100
    assert known.not_known(spark.range(5).selectExpr("id as k"), known.read_bitmaps(spark, f"{tmp_path}/none"), history, "k").count() == 5
    assert known.not_known(spark.range(0).selectExpr("id as k"), bitmaps, history, "k").count() == 0


def test_only_hits_meet_the_history(spark, tmp_path):
    history, incoming = spark.range(0, 4000).selectExpr("id as k"), spark.range(3990, 8000).selectExpr("id as k")
    known.add_known(history, str(tmp_path), "k", "a")
    new, hits = known.split_by_bitmap(incoming, known.read_bitmaps(spark, str(tmp_path)), "k")
    assert (new.count(), hits.count()) == (4000, 10)
    plan = known.not_known(incoming, known.read_bitmaps(spark, str(tmp_path)), history, "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [k" in plan and "SortMergeJoin" not in plan
