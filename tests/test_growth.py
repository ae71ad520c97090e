import datetime as dt

from pyspark.sql import functions as F

from playlake.operators.growth import game_growth, genre_growth, publisher_growth

D1, D2, D5 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5)


def fact(spark, rows=((D1, 1, 100), (D2, 1, 110), (D5, 1, 150))):
    return spark.createDataFrame(list(rows), "snapshot_date date, appid bigint, recommendations_total bigint")


def dim(spark, rows=((1, ["Action", "RPG"], ["P"]),)):
    return spark.createDataFrame(list(rows), "appid bigint, genres array<string>, publishers array<string>")


def test_row_based_lags_default_zero(spark):  # W1-W3, T1, T2
    got = [(r.snapshot_date, r.rec_growth_1d, r.rec_growth_7d, r.rec_growth_30d)
           for r in game_growth(fact(spark)).orderBy("snapshot_date").collect()]
    assert got == [(D1, 100, 100, 100), (D2, 10, 110, 110), (D5, 40, 150, 150)]


def test_missing_null_option(spark):
    r = game_growth(fact(spark), missing="null").orderBy("snapshot_date").first()
    assert r.rec_growth_1d is None


def test_one_exchange_one_window(spark):  # section 3.2
    plan = game_growth(fact(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Window [") == 1


def test_genre_view_explodes_and_averages(spark):  # D6, T22
    out = genre_growth(game_growth(fact(spark)), dim(spark)).orderBy("snapshot_date", "genre").collect()
    assert [(r.snapshot_date, r.genre, r.genre_growth_1d, r.genre_growth_7d, r.avg_recommendations) for r in out] == [
        (D1, "Action", 100, 100, 100.0), (D1, "RPG", 100, 100, 100.0),
        (D2, "Action", 10, 110, 110.0), (D2, "RPG", 10, 110, 110.0),
        (D5, "Action", 40, 150, 150.0), (D5, "RPG", 40, 150, 150.0),
    ]


def test_no_dim_or_empty_lists_vanish(spark):  # T23
    f = fact(spark, [(D1, 1, 5), (D1, 2, 7), (D1, 3, 9)])
    d = dim(spark, [(2, [], []), (3, ["Indie"], ["Q"])])
    g = game_growth(f)
    assert [(r.genre, r.genre_growth_1d) for r in genre_growth(g, d).collect()] == [("Indie", 9)]
    assert [(r.publisher, r.pub_growth_1d) for r in publisher_growth(g, d).collect()] == [("Q", 9)]


def test_duplicate_genre_counts_twice(spark):  # T15
    g = game_growth(fact(spark, [(D1, 1, 5)]))
    out = genre_growth(g, dim(spark, [(1, ["RPG", "RPG"], [])])).first()
    assert out.genre_growth_1d == 10


def test_one_snapshot_deltas_sum_to_last_total(spark):  # section 5 invariant, on the lineitem binding
    from playlake.plans.bindings import fact_from_lineitem, table

    f = fact_from_lineitem(table(spark, "/root/testdata/sf0.001", "lineitem"))
    g = game_growth(f)
    sums = g.groupBy("appid").agg(F.sum("rec_growth_1d").alias("s"),
                                  F.max_by("recommendations_total", "snapshot_date").alias("last"))
    assert sums.where(F.col("s") != F.col("last")).count() == 0
