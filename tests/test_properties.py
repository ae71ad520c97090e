"""Property tests: random small inputs, Spark operators vs brute force in Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from playlake.operators.growth import game_growth
from playlake.operators.silver import company_bridge, dedup_snapshots

D0 = dt.date(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

facts = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 40), st.integers(-50, 500)),
                 min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@SETTINGS
@given(facts)
def test_growth_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(D0 + dt.timedelta(days=d), a, v) for a, d, v in rows],
                               "snapshot_date date, appid bigint, recommendations_total bigint")
    got = {(r.appid, r.snapshot_date): (r.rec_growth_1d, r.rec_growth_7d, r.rec_growth_30d)
           for r in game_growth(df).collect()}
    want = {}
    for a in {r[0] for r in rows}:
        series = sorted((d, v) for aa, d, v in rows if aa == a)
        for i, (d, v) in enumerate(series):
            lag = [series[i - n][1] if i - n >= 0 else 0 for n in (1, 7, 30)]
            want[(a, D0 + dt.timedelta(days=d))] = tuple(v - x for x in lag)
    assert got == want


fetches = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 2), st.one_of(st.none(), st.integers(0, 20))),
                   min_size=1, max_size=30)


@SETTINGS
@given(fetches)
def test_dedup_matches_brute_force(spark, rows):
    data = [(a, D0 + dt.timedelta(days=d), None if t is None else dt.datetime(2024, 1, 1, t), i)
            for i, (a, d, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "appid bigint, snapshot_date date, fetched_at timestamp_ntz, i int")
    got = {(r.appid, r.snapshot_date): r.fetched_at for r in dedup_snapshots(df).collect()}
    want = {}
    for a, d, t, _ in data:
        key = (a, d)
        cur = want.get(key, "unset")
        if cur == "unset" or (cur is not None and (t is None or t > cur)):
            want[key] = t  # NULL wins, else the latest
    assert got == want


companies = st.lists(st.tuples(st.integers(1, 3), st.lists(st.sampled_from(["A", "B", None]), max_size=4),
                               st.lists(st.sampled_from(["A", "C", None]), max_size=4)), min_size=1, max_size=10)


@SETTINGS
@given(companies)
def test_company_bridge_is_a_set_per_role(spark, rows):
    df = spark.createDataFrame([(D0, a, dv, pb) for a, dv, pb in rows],
                               "snapshot_date date, appid bigint, developers array<string>, publishers array<string>")
    got = sorted((r.appid, r.company, r.role) for r in company_bridge(df).collect())
    want = sorted({(a, c, "developer") for a, dv, _ in rows for c in dv if c is not None}
                  | {(a, c, "publisher") for a, _, pb in rows for c in pb if c is not None})
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(facts, st.lists(st.integers(1, 39), max_size=3, unique=True))
def test_incremental_growth_equals_full_window(spark, rows, cuts):
    from pyspark.sql import functions as F

    from playlake.operators.growth_state import TAIL_COLUMNS, TAIL_DDL, batch_growth, next_tail

    df = spark.createDataFrame([(D0 + dt.timedelta(days=d), a, v) for a, d, v in rows],
                               "snapshot_date date, appid bigint, recommendations_total bigint")
    ends = [D0 + dt.timedelta(days=d) for d in [*sorted(cuts), 41]]
    tail, through, got = spark.createDataFrame([], TAIL_DDL), None, set()
    for end in ends:
        batch = df.where(F.col("snapshot_date") <= F.lit(end))
        batch = batch if through is None else batch.where(F.col("snapshot_date") > F.lit(through))
        got |= {tuple(r) for r in batch_growth(tail, batch, through).collect()}
        tail = next_tail(tail.unionByName(batch.select(*TAIL_COLUMNS)))
        tail = spark.createDataFrame(tail.collect(), tail.schema)  # cut lineage between batches
        through = end
    assert got == {tuple(r) for r in game_growth(df).collect()}


loads = st.lists(st.tuples(st.sampled_from(["replace_date", "append"]),
                           st.lists(st.tuples(st.integers(0, 40), st.integers(1, 3)), min_size=1, max_size=6)),
                 min_size=1, max_size=3)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(loads)
def test_fact_loads_match_a_model(spark, seq):
    from playlake.operators.gold import build_fact
    from playlake.schemas import SILVER_MAIN_DDL
    from playlake.session import scratch_path
    from playlake.sources.lake import read_fact, write_fact

    path, model = scratch_path(spark, "t_prop_fact"), []
    cols = [c.split()[0] for c in SILVER_MAIN_DDL.split(", ")]
    for n, (mode, rows) in enumerate(seq):
        # day offsets spread over two months so month folders are shared and split
        batch = [(D0 + dt.timedelta(days=d), a, n) for d, a in rows]
        data = [tuple({"appid": a, "snapshot_date": day, "recommendations_total": n}.get(c) for c in cols)
                for day, a, n in batch]
        write_fact(build_fact(spark.createDataFrame(data, SILVER_MAIN_DDL)), path, mode=mode)
        if mode == "replace_date" and model:
            days = {b[0] for b in batch}
            model = [m for m in model if m[0] not in days]
        model += batch
    got = sorted((r.snapshot_date, r.appid, r.recommendations_total) for r in read_fact(spark, path).collect())
    assert got == sorted(model)


@SETTINGS
@given(st.lists(st.tuples(st.lists(st.integers(1, 99), max_size=3), st.one_of(st.none(), st.booleans())),
                min_size=1, max_size=6))
def test_pages_stop_at_first_final_page(spark, pages):
    import json

    from playlake.sources.landing import unwrap_pages

    bodies = []
    for i, (apps, more) in enumerate(pages):
        resp = {"apps": [{"appid": a + 100 * i} for a in apps]}
        if more is not None:
            resp["have_more_results"] = more
        bodies.append(("s", i, json.dumps({"response": resp})))
    landed = spark.createDataFrame(bodies, "snapshot string, page_no bigint, body string")
    got = sorted(r.appid for r in unwrap_pages(landed, "snapshot", strict=False).collect())
    want = []
    for i, (apps, more) in enumerate(pages):
        want += [a + 100 * i for a in apps]
        if not more:
            break
    assert got == sorted(want)
