"""Gold in buckets of appid against the plain tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlake.operators.gold import latest_dim
from playlake.plans.bindings import whole_fact_rows
from playlake.plans.medallion import gold_views
from playlake.schemas import DIM_DDL
from playlake.session import scratch_path
from playlake.sources.by_game import by_game_path, read_by_game, refresh_by_game
from playlake.sources.lake import (
    DIM_TABLE, FACT_TABLE, append_dim_versions, read_dim_log, read_fact, replace_fact_date, table_path, write_fact,
)

SHUFFLE = "Exchange hashpartitioning"


def facts(spark, days, games=40, add=0):
    rows = [(d, g, (g * 7 + n * n) % 50 + add) for n, d in enumerate(days) for g in range(games) if (g + n) % 5]
    return whole_fact_rows(spark.createDataFrame(rows, "snapshot_date date, appid bigint, recommendations_total bigint"))


def dims(spark, games, mark=""):
    rows = [(g, f"g{g}", "game", None, None, None, [f"a{g % 3}{mark}", "all"] if g % 7 else None, None, None,
             [f"p{g % 4}"], dt.datetime(2024, 1, 1)) for g in games]
    return spark.createDataFrame(rows, DIM_DDL)


def days(start, n):
    return [start + dt.timedelta(i) for i in range(n)]


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def same_as_plain(spark, gold, buckets):
    fact, dim = read_by_game(spark, gold, buckets)
    assert rows_of(fact) == rows_of(read_fact(spark, table_path(gold, FACT_TABLE)))
    assert rows_of(dim) == rows_of(latest_dim(read_dim_log(spark, table_path(gold, DIM_TABLE))))
    plain, dealt = gold_views(spark, gold), gold_views(spark, gold, buckets=buckets)
    for name in plain:
        assert rows_of(plain[name]) == rows_of(dealt[name])


@pytest.fixture
def gold(spark):
    root = scratch_path(spark, "t_bygame")
    write_fact(facts(spark, days(dt.date(2024, 1, 20), 30)), table_path(root, FACT_TABLE))
    append_dim_versions(dims(spark, range(35)), table_path(root, DIM_TABLE), 1)
    return root


def test_views_equal_and_move_only_the_sums(spark, gold):
    refresh_by_game(spark, gold, buckets=6)
    same_as_plain(spark, gold, 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold_views(spark, gold, buckets=6)["view_genre_growth"]._jdf.queryExecution().executedPlan().toString()
        plain = gold_views(spark, gold)["view_genre_growth"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count(SHUFFLE) == 1 and "SortMergeJoin" in plan and "Window" in plan
    assert plan.index("HashAggregate") < plan.index(SHUFFLE) < plan.index("SortMergeJoin")
    assert plain.count(SHUFFLE) > 1


def test_a_month_of_a_bucket_is_one_file(spark, gold):
    refresh_by_game(spark, gold, buckets=6)
    files = read_by_game(spark, gold, 6)[0].inputFiles()
    assert len(files) == len({(f.split("snapshot_month=")[1][:6], f.rsplit("_", 1)[1][:5]) for f in files}) <= 12


def test_only_the_months_of_the_load_are_rewritten(spark, gold):
    refresh_by_game(spark, gold, buckets=6)
    january = sorted(f for f in read_by_game(spark, gold, 6)[0].inputFiles() if "202401" in f)
    write_fact(facts(spark, [dt.date(2024, 2, 3)], add=9), table_path(gold, FACT_TABLE))
    append_dim_versions(dims(spark, range(30, 45), "x"), table_path(gold, DIM_TABLE), 2)
    refresh_by_game(spark, gold, "2024-02-03", "2024-02-03", buckets=6)
    assert sorted(f for f in read_by_game(spark, gold, 6)[0].inputFiles() if "202401" in f) == january
    same_as_plain(spark, gold, 6)


def test_an_emptied_month_goes(spark, gold):
    refresh_by_game(spark, gold, buckets=6)
    none = facts(spark, []).limit(0)
    for day in days(dt.date(2024, 1, 20), 12):
        replace_fact_date(none, table_path(gold, FACT_TABLE), day)
    refresh_by_game(spark, gold, "2024-01-20", "2024-01-31", buckets=6)
    same_as_plain(spark, gold, 6)
    assert read_by_game(spark, gold, 6)[0].agg(F.min("snapshot_date")).first()[0] == dt.date(2024, 2, 1)


def test_empty_gold_and_no_copy(spark, gold):
    with pytest.raises(ValueError, match="no copy in 5 buckets"):
        read_by_game(spark, gold, 5)
    empty = scratch_path(spark, "t_bygame_empty")
    refresh_by_game(spark, empty, buckets=3)
    fact, dim = read_by_game(spark, empty, 3)
    assert fact.count() == 0 and dim.count() == 0
    assert "by_game_3" in by_game_path(empty, DIM_TABLE, 3)


def test_copies_in_other_numbers_of_buckets_stand_apart(spark, gold):
    refresh_by_game(spark, gold, buckets=3)
    refresh_by_game(spark, gold, buckets=5)
    same_as_plain(spark, gold, 3)
    same_as_plain(spark, gold, 5)
