import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from playlake.operators.gold import build_dim, build_fact, latest_dim
from playlake.schemas import DIM_COLUMNS, FACT_COLUMNS, SILVER_MAIN_DDL
from playlake.session import scratch_path
from playlake.sources.lake import (
    append_dim_versions, ensure_tables, read_dim_log, read_fact, replace_fact_date, table_contract,
    write_fact,
)

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def silver_rows(spark, rows):
    cols = [c.split()[0] for c in SILVER_MAIN_DDL.split(", ")]
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, SILVER_MAIN_DDL)


def test_fact_defaults_for_nulls(spark):  # F8, T18
    df = silver_rows(spark, [{"appid": 1, "snapshot_date": D1}])
    r = build_fact(df).first()
    assert (r.currency, r.discount_percent, r.recommendations_total, r.metacritic_score,
            r.achievements_total, r.is_free, r.price, r.price_usd) == ("USD", 0, 0, -1, 0, 0, None, None)
    assert build_fact(df).columns == FACT_COLUMNS


def test_fact_fetched_at_whole_seconds(spark):  # T28
    df = silver_rows(spark, [{"appid": 1, "snapshot_date": D1,
                              "fetched_at": dt.datetime(2024, 1, 1, 1, 2, 3, 900000), "price": 9.99}])
    f = build_fact(df)
    assert f.schema["fetched_at"].dataType.typeName() == "timestamp_ntz"
    r = f.first()
    assert r.fetched_at == dt.datetime(2024, 1, 1, 1, 2, 3) and r.price_usd == 9.99


@pytest.mark.parametrize("row", [{"discount_percent": 300}, {"metacritic_score": 40000}])
def test_fact_narrow_casts_raise(spark, row):  # T16
    df = silver_rows(spark, [{"appid": 1, "snapshot_date": D1, **row}])
    with pytest.raises(PySparkException):
        build_fact(df).collect()


def _empty_bridges(spark):
    g = spark.createDataFrame([], "snapshot_date date, appid bigint, genre string")
    c = spark.createDataFrame([], "snapshot_date date, appid bigint, category string")
    co = spark.createDataFrame([], "snapshot_date date, appid bigint, company string, role string")
    return g, c, co


def test_dim_defaults_and_age_check(spark):  # A5, F8, T16, T19
    g, c, co = _empty_bridges(spark)
    main = silver_rows(spark, [{"appid": 1, "snapshot_date": D1, "name": "x"}])
    r = build_dim(main, g, c, co, updated_at=dt.datetime(2024, 2, 1)).first()
    assert (r.type, r.required_age, r.coming_soon, r.genres, r.publishers) == ("unknown", 0, 0, [], [])
    old = silver_rows(spark, [{"appid": 1, "snapshot_date": D1, "name": "x", "required_age": 256}])
    with pytest.raises(PySparkException):
        build_dim(old, g, c, co).collect()
    nameless = silver_rows(spark, [{"appid": 1, "snapshot_date": D1}])
    with pytest.raises(PySparkException, match="name"):
        build_dim(nameless, g, c, co).collect()


def test_dim_range_uses_latest_day_lists(spark):  # T33, T15
    main = silver_rows(spark, [{"appid": 1, "snapshot_date": D1, "name": "old"},
                               {"appid": 1, "snapshot_date": D2, "name": "new"}])
    genres = spark.createDataFrame([(D1, 1, "Action"), (D2, 1, "RPG"), (D2, 1, "Indie")],
                                   "snapshot_date date, appid bigint, genre string")
    _, c, _ = _empty_bridges(spark)
    companies = spark.createDataFrame([(D2, 1, "Z", "developer"), (D2, 1, "Z", "publisher"), (D1, 1, "Y", "publisher")],
                                      "snapshot_date date, appid bigint, company string, role string")
    r = build_dim(main, genres, c, companies, updated_at=dt.datetime(2024, 2, 1)).first()
    assert (r.name, r.genres, r.developers, r.publishers) == ("new", ["Indie", "RPG"], ["Z"], ["Z"])


def test_latest_dim_picks_newest_version(spark, tmp_path):  # K8, W6, T4, T5
    g, c, co = _empty_bridges(spark)
    path = str(tmp_path / "dim")
    for name, ts, seq in (("v1", dt.datetime(2024, 1, 1), 1), ("v2", dt.datetime(2024, 1, 2), 2),
                          ("v3", dt.datetime(2024, 1, 2), 3)):
        main = silver_rows(spark, [{"appid": 7, "snapshot_date": D1, "name": name}])
        append_dim_versions(build_dim(main, g, c, co, updated_at=ts), path, seq)
    log = read_dim_log(spark, path)
    assert log.count() == 3
    latest = latest_dim(log).collect()
    assert [r.name for r in latest] == ["v3"] and latest_dim(log).columns == DIM_COLUMNS


def test_fact_replace_is_idempotent_and_append_duplicates(spark):  # K6, K7, T3
    rows = silver_rows(spark, [{"appid": i, "snapshot_date": D1, "recommendations_total": i} for i in range(5)]
                       + [{"appid": 9, "snapshot_date": D2}])
    fact = build_fact(rows)
    rep, app = scratch_path(spark, "t_rep"), scratch_path(spark, "t_app")
    for _ in range(2):
        write_fact(fact, rep, mode="replace_date")
        write_fact(fact, app, mode="append")
    assert read_fact(spark, rep).count() == 6
    assert read_fact(spark, app).count() == 12
    # replacing one date leaves the others alone
    replace_fact_date(fact.where(F.col("appid") == 0), rep, D1)
    got = sorted((r.snapshot_date, r.appid) for r in read_fact(spark, rep).collect())
    assert got == [(D1, 0), (D2, 9)]
    with pytest.raises(ValueError):
        replace_fact_date(fact, rep, None)


def test_ensure_tables_is_idempotent(spark, tmp_path):  # K9
    root = str(tmp_path / "lake")
    created = ensure_tables(spark, root)
    assert "fact_game_daily" in created and "dim_game" in created
    assert ensure_tables(spark, root) == []
    contract = {(r.table, r.column): r.type for r in table_contract(spark, root).collect()}
    assert contract[("fact_game_daily", "discount_percent")] == "smallint"
    assert contract[("dim_game", "genres")] == "array<string>"


def test_usd_rate_parameter(spark):  # F7, T17
    df = silver_rows(spark, [{"appid": 1, "snapshot_date": D1, "price": 10.0}])
    assert build_fact(df).first().price_usd == 10.0
    assert build_fact(df, usd_rate=1.1).first().price_usd == pytest.approx(11.0)


def test_writers_report_rows(spark):  # K11
    rows = silver_rows(spark, [{"appid": i, "snapshot_date": D1} for i in range(4)])
    path = scratch_path(spark, "t_rows")
    assert write_fact(build_fact(rows), path, mode="append") == 4
    assert write_fact(build_fact(rows.where(F.col("appid") < 2)), path, mode="replace_date") == 2
    assert read_fact(spark, path).count() == 2


def test_compact_dim_log_keeps_latest(spark):  # K8 merge
    from playlake.sources.lake import compact_dim_log

    g, c, co = _empty_bridges(spark)
    path = scratch_path(spark, "t_dimlog")
    for seq, ts in enumerate((dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)), 1):
        main = silver_rows(spark, [{"appid": a, "snapshot_date": D1, "name": f"v{seq}-{a}"} for a in (1, 2)])
        append_dim_versions(build_dim(main, g, c, co, updated_at=ts), path, seq)
    before = sorted(tuple(r) for r in latest_dim(read_dim_log(spark, path)).collect())
    assert read_dim_log(spark, path).count() == 6
    assert compact_dim_log(spark, path) == 2
    assert read_dim_log(spark, path).count() == 2
    assert sorted(tuple(r) for r in latest_dim(read_dim_log(spark, path)).collect()) == before


def test_thinning_the_dim_log_out_loses_nothing_wherever_it_stops(spark, monkeypatch):  # K8
    from playlake.sources import lake

    g, c, co = _empty_bridges(spark)
    path = scratch_path(spark, "t_dimdead")

    def load(seq, apps=(1, 2)):
        main = silver_rows(spark, [{"appid": a, "snapshot_date": D1, "name": f"v{seq}-{a}"} for a in apps])
        append_dim_versions(build_dim(main, g, c, co, updated_at=dt.datetime(2024, 1, seq)), path, seq)

    def names():
        return sorted(r.name for r in latest_dim(read_dim_log(spark, path)).collect())

    load(1, (1, 2, 3)), load(2)
    with monkeypatch.context() as m:  # dead before anything is replaced
        m.setattr(lake, "counted", lambda df: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.compact_dim_log(spark, path)
    assert names() == ["v1-3", "v2-1", "v2-2"] and read_dim_log(spark, path).count() == 5
    load(3, (1, 2, 3))
    with monkeypatch.context() as m:  # dead before the emptied folders are removed
        m.setattr(lake, "_delete_path", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.compact_dim_log(spark, path)
    assert names() == ["v3-1", "v3-2", "v3-3"]
    load(4, (1,))
    assert lake.compact_dim_log(spark, path) == 3
    assert names() == ["v3-2", "v3-3", "v4-1"] and read_dim_log(spark, path).count() == 3
    assert lake.compact_dim_log(spark, path) == 3


def test_replacing_a_day_writes_only_that_day(spark):  # K7
    import glob
    import os

    rows = silver_rows(spark, [{"appid": a, "snapshot_date": d} for a in (1, 2) for d in (D1, D2)])
    path = scratch_path(spark, "t_oneday")
    write_fact(build_fact(rows), path)
    local = path.removeprefix("file:")
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local}/*/*/*.parquet")}
    assert replace_fact_date(build_fact(rows.where(F.col("appid") == 1)).where(F.col("snapshot_date") == D1), path, D1) == 1
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{local}/*/*/*.parquet")}
    assert {f for f in before if f"snapshot_date={D2}" in f} == {f for f in after if before.get(f) == after[f]}
    assert replace_fact_date(build_fact(rows).where("false"), path, D1) == 0
    assert {r.snapshot_date for r in read_fact(spark, path).collect()} == {D2}
    with pytest.raises(ValueError):
        write_fact(build_fact(rows), path, layout="month")


def test_contract_names_an_absent_table(spark, tmp_path):  # K9
    ensure_tables(spark, str(tmp_path / "some"), ("game_daily",))
    rows = table_contract(spark, str(tmp_path / "some"), ("game_daily", "game_genre")).collect()
    assert [r.column for r in rows if r.table == "game_genre"] == [None]
    assert len([r for r in rows if r.table == "game_daily"]) == 16


def test_versions_by_snapshot_day(spark):  # T5
    g, c, co = _empty_bridges(spark)
    main = silver_rows(spark, [{"appid": 7, "snapshot_date": D1, "name": "n"}])
    assert build_dim(main, g, c, co, version_by="snapshot_date").first().updated_at.date() == D1
    with pytest.raises(ValueError):
        build_dim(main, g, c, co, version_by="other")


def test_loads_into_tables_created_empty(spark, tmp_path):  # K9 then K1/K7
    from playlake.sources.lake import read_silver, write_day_partitions

    root = str(tmp_path / "lake")
    ensure_tables(spark, root)
    fact_path = f"{root}/fact_game_daily"
    assert read_fact(spark, fact_path, D1, D2).count() == 0
    rows = silver_rows(spark, [{"appid": 1, "snapshot_date": D1}, {"appid": 2, "snapshot_date": D2}])
    assert write_fact(build_fact(rows), fact_path, mode="replace_date") == 2
    assert read_fact(spark, fact_path, D2, D2).count() == 1
    assert write_day_partitions(rows, f"{root}/game_daily") == 2
    assert read_silver(spark, root, "game_daily", D1, D1).count() == 1


def test_clustered_files_of_a_hot_day_do_not_overlap(spark):  # K10, O3
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(40_000).select(
        (F.col("id") * 7919 % 10_007).alias("appid"), F.when(F.col("id") % 10 == 0, F.lit(D2)).otherwise(F.lit(D1)).alias("snapshot_date"))
    main = silver_rows(spark, [{"appid": 1, "snapshot_date": D1}]).limit(0).unionByName(rows, allowMissingColumns=True)
    path = scratch_path(spark, "t_clustered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert write_fact(build_fact(main), path, clustered=True) == 40_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = glob.glob(f"{path.removeprefix('file:')}/*/snapshot_date={D1}/*.parquet")
    at = pq.read_schema(files[0]).names.index("appid")
    spans = sorted(
        (min(g.column(at).statistics.min for g in groups), max(g.column(at).statistics.max for g in groups))
        for groups in ([m.row_group(i) for i in range(m.num_row_groups)] for m in map(pq.read_metadata, files)))
    assert len(spans) >= 3 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    for appid in (5, 5000, 10_000):
        assert sum(low <= appid <= high for low, high in spans) <= 2
    assert read_fact(spark, path, D1, D1).where("appid = 5000").count() == rows.where(f"appid = 5000 AND id % 10 <> 0").count()


def test_records_are_dealt_by_the_number_of_lines(spark, monkeypatch):  # a task's share grew with the table
    from playlake.operators.silver import category_bridge, company_bridge, genre_bridge
    from playlake.plans import bindings as B

    monkeypatch.setattr(B, "LINES_PER_TASK", 50)
    lines = spark.range(1000).select(
        (F.col("id") % 20).alias("l_partkey"), F.timestamp_add("DAY", F.col("id") % 7, F.lit("2024-01-01 05:00:00").cast("timestamp_ntz")).alias("l_shipdate"),
        F.when(F.col("id") % 3 == 0, "R").otherwise("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"))
    part = spark.range(15).select(
        F.col("id").alias("p_partkey"), F.lit("b a").alias("p_name"), F.lit("T").alias("p_type"), F.lit(3).alias("p_size"))
    main, rows = B.part_day_records(lines, part), B.line_records(lines, part)
    assert B.lines_by_part(lines).rdd.getNumPartitions() == 20
    dim = build_dim(main, genre_bridge(main), category_bridge(main), company_bridge(rows), updated_at=dt.datetime(2024, 2, 1))
    got = {r.appid: (r.release_date, r.genres, r.categories, sorted(r.developers), r.publishers) for r in dim.collect()}
    assert got == {i: (dt.date(2024, 1, 4), ["a", "b"], ["T"], ["A", "R"], ["O"]) for i in range(15)}


def test_dim_leaves_out_bridge_rows_of_other_days(spark):  # the day is compared by range, earlier and later ones stay out
    g, c, co = _empty_bridges(spark)
    main = silver_rows(spark, [{"appid": 1, "snapshot_date": D1, "name": "x"}, {"appid": 2, "snapshot_date": D2, "name": "y"}])
    genres = spark.createDataFrame(
        [(D1, 1, "a"), (D1, 1, "a"), (D2, 1, "late"), (None, 1, "none"), (D1, 2, "early"), (D2, None, "nobody")], g.schema)
    got = {r.appid: r.genres for r in build_dim(main, genres, c, co, updated_at=dt.datetime(2024, 2, 1)).collect()}
    assert got == {1: ["a", "a"], 2: []}
