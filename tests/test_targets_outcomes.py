"""Planned targets reconciled with landed attempts."""

import datetime as dt

from playlake.sources.landing import attempt_outcomes, reconcile_targets, target_counts

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def body(appid, success):
    return f'{{"{appid}":{{"success":{str(success).lower()},"data":{{}}}}}}'


def outcomes(spark, targets, bodies):
    planned = spark.createDataFrame(targets, "snapshot_date date, appid bigint")
    landed = spark.createDataFrame(bodies, "snapshot_date date, requested_appid bigint, body string")
    return reconcile_targets(planned, attempt_outcomes(landed, keep=("requested_appid",)))


def test_outcomes(spark):
    bodies = [
        (D1, 1, body(1, True)),
        (D1, 2, body(2, False)), (D1, 2, "cut sho"), (D1, 2, body(2, True)),  # retried, came out ok
        (D1, 3, body(3, True)), (D1, 3, body(3, False)),  # a success is kept whatever follows
        (D1, 4, body(4, False)), (D1, 4, body(9, True)),  # another app's body is no answer
        (D1, 6, body(6, True)),
        (D2, 1, None),
        (None, 1, body(1, True)), (D1, None, body(1, True)),
    ]
    targets = [(D1, a) for a in (1, 2, 3, 4, 5, 5, None)] + [(D2, 1), (D2, 7)]
    df = outcomes(spark, targets, bodies)
    got = {(r.snapshot_date, r.appid): (r.outcome, r.n_attempts) for r in df.collect()}
    assert got == {
        (D1, 1): ("ok", 1), (D1, 2): ("ok", 3), (D1, 3): ("ok", 2), (D1, 4): ("err", 2), (D1, 5): ("unanswered", 0),
        (D1, 6): ("unplanned", 1), (D2, 1): ("err", 1), (D2, 7): ("unanswered", 0),
        (None, 1): ("unplanned", 1), (D1, None): ("unplanned", 1),
    }
    counts = {r.snapshot_date: tuple(r)[1:] for r in target_counts(df).collect()}
    assert counts == {D1: (3, 2, 5, 1, 2, 3, 2), D2: (0, 2, 2, 1, 0, 0, 0), None: (0, 0, 0, 0, 1, 0, 0)}


def test_nothing_planned_or_nothing_landed(spark):
    assert outcomes(spark, [], []).count() == 0
    assert target_counts(outcomes(spark, [], [])).count() == 0
    assert [r.outcome for r in outcomes(spark, [(D1, 1)], []).collect()] == ["unanswered"]
    assert [r.outcome for r in outcomes(spark, [], [(D1, 1, "x")]).collect()] == ["unplanned"]


def test_retries_of_a_hot_app_are_reduced_before_the_join(spark):
    df = outcomes(spark, [(D1, 1)], [(D1, 1, body(1, i == 700)) for i in range(2000)])
    assert [tuple(r)[2:] for r in df.collect()] == [("ok", 2000)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_bool_or" in plan or "partial_max" in plan
