from playlake.operators.targets import daily_targets, full_load_targets


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "appid bigint")


def test_daily_targets_is_a_set(spark):  # D8, J4, T29
    got = sorted(r.appid for r in daily_targets(ids(spark, [1, 1, 2, 3, None]), ids(spark, [2])).collect())
    assert got == [1, 3]


def test_full_load_targets_is_a_list(spark):  # D9, J5
    got = sorted(r.appid for r in full_load_targets(ids(spark, [1, 1, 2, None, 5]), ids(spark, [2])).collect())
    assert got == [0, 1, 1, 5]
    got = sorted(r.appid for r in full_load_targets(ids(spark, [None, 3]), ids(spark, [0])).collect())
    assert got == [3]

