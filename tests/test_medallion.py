import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from playlake.operators.gold import latest_dim
from playlake.plans.medallion import register_views, run_range
from playlake.session import scratch_path
from playlake.sources.lake import read_dim_log, read_fact, read_silver, table_path


def rec(appid, day, total, genres, pubs, hour=1):
    return {"appid": appid, "success": True, "fetched_at": f"2024-01-{day:02d}T{hour:02d}:00:00",
            "data": {"name": f"g{appid}", "type": "game", "recommendations": {"total": total},
                     "genres": [{"id": str(i), "description": g} for i, g in enumerate(genres)],
                     "developers": ["Dev"], "publishers": pubs}}


def land(write_jsonl):
    root = None
    days = {
        1: [rec(1, 1, 100, ["Action", "RPG"], ["P"]), rec(2, 1, 5, ["Indie"], ["Q"])],
        2: [rec(1, 2, 110, ["Action", "RPG"], ["P"]), rec(1, 2, 999, ["x"], ["x"], hour=0)],  # older copy loses
        # day 3 never landed
        4: [rec(1, 4, 150, ["Action", "RPG", "Strategy"], ["P"]), rec(2, 4, 9, ["Indie"], ["Q", "R"])],
    }
    for d, rows in days.items():
        root = write_jsonl(f"bronze/year=2024/month=01/day={d:02d}/part-0.jsonl.gz", rows)
    return f"{root}/bronze"


def test_range_run_views_and_invariants(spark, write_jsonl):
    bronze = land(write_jsonl)
    base = scratch_path(spark, "t_medallion")
    silver, gold = f"{base}/silver", f"{base}/gold"
    report = run_range(spark, bronze, silver, gold, "2024-01-01", "2024-01-04",
                       updated_at=dt.datetime(2024, 2, 1), load_seq=1)
    status = {r.snapshot_date.day: (r.silver_rows, r.status) for r in report.collect()}
    assert status == {1: (2, "loaded"), 2: (1, "loaded"), 3: (0, "skipped"), 4: (2, "loaded")}

    fact_path = table_path(gold, "fact_game_daily")
    first = sorted((r.snapshot_date, r.appid, r.recommendations_total) for r in read_fact(spark, fact_path).collect())
    run_range(spark, bronze, silver, gold, "2024-01-01", "2024-01-04",
              updated_at=dt.datetime(2024, 2, 2), load_seq=2)
    again = sorted((r.snapshot_date, r.appid, r.recommendations_total) for r in read_fact(spark, fact_path).collect())
    assert first == again and len(first) == 5  # replace-date twice = once (T3)

    dim = latest_dim(read_dim_log(spark, table_path(gold, "dim_game")))
    rows = {r.appid: r for r in dim.collect()}
    assert rows[1].genres == ["Action", "RPG", "Strategy"] and rows[2].publishers == ["Q", "R"]
    assert rows[1].updated_at == dt.datetime(2024, 2, 2)

    # bridge rows of each game's latest day re-aggregate to the dim lists (section 5)
    genres = read_silver(spark, silver, "game_genre")
    latest = genres.groupBy("appid").agg(F.max("snapshot_date").alias("snapshot_date"))
    regrouped = (genres.join(latest, ["appid", "snapshot_date"])
                 .groupBy("appid").agg(F.array_sort(F.collect_list("genre")).alias("g")))
    assert {r.appid: r.g for r in regrouped.collect()} == {k: v.genres for k, v in rows.items()}

    assert sorted(register_views(spark, gold)) == ["view_game_growth", "view_genre_growth", "view_publisher_growth"]
    got = {(r.snapshot_date.day, r.genre): (r.genre_growth_1d, r.genre_growth_7d) for r in spark.sql(
        "SELECT * FROM view_genre_growth WHERE genre IN ('Action', 'Strategy')").collect()}
    # Action on day 4: game 1 went 110 -> 150 (1 snapshot back); Strategy only exists in the latest dim
    assert got[(4, "Action")] == (40, 150) and got[(1, "Action")] == (100, 100) and got[(4, "Strategy")] == (40, 150)
    pubs = {(r.snapshot_date.day, r.publisher): r.pub_growth_1d for r in spark.sql(
        "SELECT * FROM view_publisher_growth").collect()}
    assert pubs[(4, "R")] == 4 and pubs[(4, "Q")] == 4


def test_a_rerun_replaces_the_day_in_every_table(spark, write_jsonl):  # K1, K2, D2, D11
    from playlake.plans.medallion import load_silver

    base = scratch_path(spark, "t_rerun")
    first = write_jsonl("r1/year=2024/month=01/day=01/a.jsonl.gz", [rec(1, 1, 5, ["RPG", "Indie"], ["P"])])
    write_jsonl("r1/year=2024/month=01/day=02/a.jsonl.gz", [rec(1, 2, 6, ["RPG"], ["P"])])
    counts = load_silver(spark, f"{first}/r1", f"{base}/silver", "2024-01-01", "2024-01-05")
    assert counts == {"game_daily": 2, "game_genre": 3, "game_category": 0, "game_company": 4, "malformed": 0}
    no_genres = rec(1, 1, 5, [], [])
    no_genres["data"]["developers"] = []
    write_jsonl("r2/year=2024/month=01/day=01/a.jsonl.gz", [no_genres], raw_lines=None)
    failed = {"appid": 1, "success": False, "fetched_at": "2024-01-02T01:00:00"}
    write_jsonl("r2/year=2024/month=01/day=02/a.jsonl.gz", [], raw_lines=[json.dumps(failed), '{"appid": 2, "succ'])
    counts = load_silver(spark, f"{first}/r2", f"{base}/silver", "2024-01-01", "2024-01-05")
    assert counts == {"game_daily": 1, "game_genre": 0, "game_category": 0, "game_company": 0, "malformed": 1}
    assert [r.snapshot_date.day for r in read_silver(spark, f"{base}/silver", "game_daily").collect()] == [1]
    assert read_silver(spark, f"{base}/silver", "game_genre").count() == 0
    assert read_silver(spark, f"{base}/silver", "game_company").count() == 0


def test_out_of_range_rows_fail_or_go_to_quarantine(spark, write_jsonl):  # T16
    from playlake.plans.medallion import load_gold, load_silver

    base = scratch_path(spark, "t_quarantine")
    bad = rec(2, 1, 5, ["RPG"], ["P"])
    bad["data"]["required_age"] = "999"
    root = write_jsonl("q/year=2024/month=01/day=01/a.jsonl.gz", [rec(1, 1, 5, ["RPG"], ["P"]), bad])
    load_silver(spark, f"{root}/q", f"{base}/silver", "2024-01-01", "2024-01-01")
    with pytest.raises(Exception, match="required_age out of range"):
        load_gold(spark, f"{base}/silver", f"{base}/gold", "2024-01-01", "2024-01-01")
    counts = load_gold(spark, f"{base}/silver", f"{base}/gold2", "2024-01-01", "2024-01-01", out_of_range="quarantine")
    assert counts == {"fact_game_daily": 1, "dim_game": 1, "quarantine": 1}
    held = spark.read.parquet(f"{base}/gold2/quarantine").first()
    assert (held.appid, held.out_of_range) == (2, ["required_age"])
