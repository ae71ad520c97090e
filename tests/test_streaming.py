import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlake.session import scratch_path
from playlake.sources.lake import read_fact, read_silver, table_path
from playlake.streaming import drain_incremental_load, start_incremental_load
from playlake.sources.paths import day_runs


def rec(appid, ts, name):
    return {"appid": appid, "success": True, "fetched_at": ts, "data": {"name": name, "type": "game",
                                                                         "recommendations": {"total": appid}}}


def test_runs_split_on_gaps():
    d = dt.date(2024, 1, 1)
    days = [d, d + dt.timedelta(1), d + dt.timedelta(3)]
    assert day_runs(days) == [(d, d + dt.timedelta(1)), (d + dt.timedelta(3), d + dt.timedelta(3))]


def test_incremental_load_handles_late_files(spark, write_jsonl):
    root = write_jsonl("b/year=2024/month=01/day=05/a.jsonl.gz",
                       [rec(1, "2024-01-05T01:00:00", "first"), rec(2, "2024-01-05T01:00:00", "x")])
    write_jsonl("b/year=2024/month=01/day=06/a.jsonl.gz", [rec(1, "2024-01-06T01:00:00", "y")])
    bronze, silver, gold = f"{root}/b", scratch_path(spark, "t_silver"), scratch_path(spark, "t_gold")
    ckpt = scratch_path(spark, "t_ckpt")
    days = drain_incremental_load(spark, bronze, silver, gold, checkpoint=ckpt, updated_at=dt.datetime(2024, 2, 1),
                                  max_files_per_trigger=1)
    assert days == [dt.date(2024, 1, 5), dt.date(2024, 1, 6)]
    assert read_silver(spark, silver, "game_daily").count() == 3
    # a late file for day 5 with a newer fetch of app 1, and a new day 7
    write_jsonl("b/year=2024/month=01/day=05/b.jsonl.gz", [rec(1, "2024-01-05T09:00:00", "second")])
    write_jsonl("b/year=2024/month=01/day=07/a.jsonl.gz", [rec(3, "2024-01-07T01:00:00", "z")])
    days = drain_incremental_load(spark, bronze, silver, gold, checkpoint=ckpt, updated_at=dt.datetime(2024, 2, 2))
    assert days == [dt.date(2024, 1, 5), dt.date(2024, 1, 7)]
    main = read_silver(spark, silver, "game_daily")
    assert main.count() == 4
    assert main.where((F.col("appid") == 1) & (F.col("snapshot_date") == dt.date(2024, 1, 5))).first().name == "second"
    assert read_fact(spark, table_path(gold, "fact_game_daily")).count() == 4


def test_compaction_triggers_nothing(spark, write_jsonl):  # D10
    from playlake.sources.bronze import compact_bronze, read_bronze

    for n in range(3):
        root = write_jsonl(f"cp/year=2024/month=01/day=05/{n}.jsonl.gz", [rec(n, f"2024-01-05T0{n}:00:00", "a")])
    bronze, silver, ckpt = f"{root}/cp", scratch_path(spark, "t_cpsilver"), scratch_path(spark, "t_cpckpt")
    assert drain_incremental_load(spark, bronze, silver, checkpoint=ckpt) == [dt.date(2024, 1, 5)]
    assert compact_bronze(spark, bronze, "2024-01-05", "2024-01-05", landed_before=dt.datetime(2020, 1, 1)) == []
    assert len(compact_bronze(spark, bronze, "2024-01-05", "2024-01-05")) == 1
    assert read_bronze(spark, bronze).count() == 3 and len(read_bronze(spark, bronze).inputFiles()) == 1
    assert drain_incremental_load(spark, bronze, silver, checkpoint=ckpt) == []
    write_jsonl("cp/year=2024/month=01/day=05/late.jsonl.gz", [rec(9, "2024-01-05T09:00:00", "a")])
    assert drain_incremental_load(spark, bronze, silver, checkpoint=ckpt) == [dt.date(2024, 1, 5)]
    assert read_silver(spark, silver, "game_daily").count() == 4


def test_restart_without_new_files_is_a_no_op(spark, write_jsonl):
    root = write_jsonl("nb/year=2024/month=01/day=05/a.jsonl.gz", [rec(1, "2024-01-05T01:00:00", "a")])
    silver, ckpt = scratch_path(spark, "t_nsilver"), scratch_path(spark, "t_nckpt")
    assert drain_incremental_load(spark, f"{root}/nb", silver, checkpoint=ckpt) == [dt.date(2024, 1, 5)]
    assert drain_incremental_load(spark, f"{root}/nb", silver, checkpoint=ckpt) == []
    assert read_silver(spark, silver, "game_daily").count() == 1


def test_days_noted_by_a_run_that_died_are_made_up_for(spark, write_jsonl, monkeypatch):
    from playlake.streaming import incremental

    root = write_jsonl("dd/year=2024/month=01/day=05/a.jsonl.gz", [rec(1, "2024-01-05T01:00:00", "a")])
    silver, ckpt = scratch_path(spark, "t_dsilver"), scratch_path(spark, "t_dckpt")
    with monkeypatch.context() as m:
        m.setattr(incremental, "_rebuild", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            drain_incremental_load(spark, f"{root}/dd", silver, checkpoint=ckpt)
    assert drain_incremental_load(spark, f"{root}/dd", silver, checkpoint=ckpt) == [dt.date(2024, 1, 5)]
    assert read_silver(spark, silver, "game_daily").count() == 1


def test_continuous_stream_rebuilds_touched_days(spark, write_jsonl):
    root = write_jsonl("cs/year=2024/month=01/day=05/a.jsonl.gz", [rec(1, "2024-01-05T01:00:00", "a")])
    silver = scratch_path(spark, "t_csilver")
    q = start_incremental_load(spark, f"{root}/cs", silver, checkpoint=scratch_path(spark, "t_cckpt"), every="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_silver(spark, silver, "game_daily").count() == 1


def test_stream_maintains_growth_and_rebuilds_on_late_data(spark, write_jsonl):
    from playlake.operators.growth import game_growth
    from playlake.plans.medallion import read_growth

    def land_day(day, recs, name="a"):
        return write_jsonl(f"g/year=2024/month=01/day={day:02d}/{name}.jsonl.gz", recs)

    def growth_rec(appid, day, total, hour=1):
        r = rec(appid, f"2024-01-{day:02d}T{hour:02d}:00:00", "n")
        r["data"]["recommendations"]["total"] = total
        return r

    root = land_day(5, [growth_rec(1, 5, 10), growth_rec(2, 5, 3)])
    land_day(6, [growth_rec(1, 6, 15)])
    base = scratch_path(spark, "t_sgrowth")
    args = dict(gold_root=f"{base}/gold", growth_root=f"{base}/growth", checkpoint=f"{base}/ckpt",
                updated_at=dt.datetime(2024, 2, 1))

    def run_and_compare():
        drain_incremental_load(spark, f"{root}/g", f"{base}/silver", **args)
        fact = read_fact(spark, table_path(f"{base}/gold", "fact_game_daily"))
        full = {tuple(r) for r in game_growth(fact).collect()}
        mat = {tuple(r) for r in read_growth(spark, f"{base}/growth").collect()}
        assert mat == full
        return full

    assert len(run_and_compare()) == 3
    land_day(7, [growth_rec(1, 7, 30)])  # forward: advanced incrementally
    assert len(run_and_compare()) == 4
    land_day(5, [growth_rec(2, 5, 8, hour=9)], name="late")  # late data for day 5: rebuild
    rows = run_and_compare()
    assert (dt.date(2024, 1, 5), 2, 8, 8, 8, 8) in rows
