"""Writes of no rows, and gold tables after a day of silver has emptied."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlake.operators.gold import build_fact
from playlake.plans.medallion import load_gold, load_silver
from playlake.schemas import DIM_DDL, SILVER_MAIN_DDL
from playlake.session import scratch_path
from playlake.sources import bronze, lake

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def silver_rows(spark, rows):
    """Silver main rows from (day, appid, discount)."""
    df = spark.createDataFrame([(a, d, f"g{a}", x, a * 10) for d, a, x in rows],
                               "appid bigint, snapshot_date date, name string, discount_percent bigint, recommendations_total bigint")
    names = [c.split()[0] for c in SILVER_MAIN_DDL.split(", ")]
    types = dict(c.split() for c in SILVER_MAIN_DDL.split(", "))
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in names])


def none_of(spark, rows, kind):
    """No rows: as a literal empty frame, after a filter, or after a shuffle that finds nothing."""
    df = silver_rows(spark, rows)
    return {"literal": spark.createDataFrame([], df.schema), "filtered": df.where("appid < 0"),
            "shuffled": df.repartition(3, "appid").dropDuplicates(["appid"]).where("length(name) > 99")}[kind]


@pytest.mark.parametrize("kind", ["literal", "filtered", "shuffled"])
def test_every_writer_takes_no_rows(spark, kind):
    empty = none_of(spark, [(D1, 1, 0)], kind)
    root = scratch_path(spark, "t_empty")
    assert bronze.write_bronze(empty, f"{root}/b") == 0
    assert bronze.write_bronze_lines(
        empty.select("appid", "snapshot_date", F.lit(True).alias("success"), F.col("name").alias("fetched_at"), F.col("name").alias("data")), f"{root}/bl") == 0
    assert bronze.land_lines(empty.select(F.col("name").alias("value"), "snapshot_date"), f"{root}/l") == 0
    assert bronze.write_applist(empty.select("appid", "name"), f"{root}/a", D1) == 0
    assert lake.write_day_partitions(empty, f"{root}/d") == 0
    assert lake.write_fact(build_fact(empty), f"{root}/f") == 0
    assert lake.write_fact(build_fact(empty), f"{root}/m", mode="append", layout="month") == 0
    dims = spark.createDataFrame([], DIM_DDL)
    assert lake.append_dim_versions(dims, f"{root}/dim", 1) == 0
    assert lake.compact_dim_log(spark, f"{root}/dim") == 0


@pytest.mark.parametrize("kind", ["literal", "filtered", "shuffled"])
def test_a_day_replaced_by_no_rows_is_empty(spark, kind):
    path = scratch_path(spark, "t_nothing")
    lake.write_fact(build_fact(silver_rows(spark, [(D1, 1, 0), (D1, 2, 0), (D2, 1, 0)])), path)
    assert lake.replace_fact_date(build_fact(none_of(spark, [(D1, 1, 0)], kind)), path, D1) == 0
    assert [(r.snapshot_date, r.appid) for r in lake.read_fact(spark, path).collect()] == [(D2, 1)]


def stored(spark, silver, rows):
    """Replace the silver main table's days by ``rows``; days without rows go."""
    path = lake.table_path(silver, "game_daily")
    lake.write_day_partitions(silver_rows(spark, rows), path)
    lake.drop_lost_days(spark, path, {d for d, *_ in rows}, dt.date.min, dt.date.max)


def fact_of(spark, gold):
    return sorted((r.snapshot_date, r.appid) for r in lake.read_fact(spark, lake.table_path(gold, lake.FACT_TABLE)).collect())


def quarantine_of(spark, gold):
    ddl = f"{SILVER_MAIN_DDL}, out_of_range array<string>"
    return sorted((r.snapshot_date, r.appid, r.out_of_range) for r in lake.read_table(spark, f"{gold}/quarantine", ddl).collect())


@pytest.mark.parametrize("bad", [0, 1, 2])
def test_quarantine_with_no_some_and_all_bad_rows(spark, bad):
    base = scratch_path(spark, "t_quarantine")
    silver, gold = f"{base}/s", f"{base}/g"
    rows = [(D1, a, 300 if a <= bad else 5) for a in (1, 2)]
    stored(spark, silver, rows)
    got = load_gold(spark, silver, gold, D1, D1, out_of_range="quarantine", load_seq=1)
    assert got == {lake.FACT_TABLE: 2 - bad, lake.DIM_TABLE: 2 - bad, "quarantine": bad}
    assert fact_of(spark, gold) == [(D1, a) for a in (1, 2) if a > bad]
    assert quarantine_of(spark, gold) == [(D1, a, ["discount_percent"]) for a in (1, 2) if a <= bad]


def test_gold_follows_silver(spark):
    base = scratch_path(spark, "t_follow")
    silver, gold = f"{base}/s", f"{base}/g"
    stored(spark, silver, [(D1, 1, 300), (D1, 2, 5), (D2, 1, 5)])
    load_gold(spark, silver, gold, D1, D2, out_of_range="quarantine", load_seq=1)
    assert fact_of(spark, gold) == [(D1, 2), (D2, 1)] and len(quarantine_of(spark, gold)) == 1
    stored(spark, silver, [(D1, 1, 5), (D1, 2, 5)])  # the bad row is good now, day 2 is lost
    load_gold(spark, silver, gold, D1, D2, out_of_range="quarantine", load_seq=2)
    assert fact_of(spark, gold) == [(D1, 1), (D1, 2)] and quarantine_of(spark, gold) == []
    stored(spark, silver, [(dt.date(2024, 2, 1), 1, 5)])  # outside the range asked for
    assert load_gold(spark, silver, gold, D2, D2) is None
    assert fact_of(spark, gold) == [(D1, 1), (D1, 2)]
    assert load_gold(spark, silver, gold, D1, D2) is None
    assert fact_of(spark, gold) == []


def test_no_silver_table_removes_nothing(spark):
    base = scratch_path(spark, "t_nosilver")
    stored(spark, f"{base}/s", [(D1, 1, 5)])
    load_gold(spark, f"{base}/s", f"{base}/g", D1, D1, load_seq=1)
    assert load_gold(spark, f"{base}/mistyped", f"{base}/g", D1, D2) is None
    assert fact_of(spark, f"{base}/g") == [(D1, 1)]


def test_appended_facts_are_not_removed(spark):
    base = scratch_path(spark, "t_append")
    stored(spark, f"{base}/s", [(D1, 1, 5), (D2, 1, 5)])
    load_gold(spark, f"{base}/s", f"{base}/g", D1, D2, fact_mode="append", load_seq=1)
    stored(spark, f"{base}/s", [(D1, 1, 5)])
    load_gold(spark, f"{base}/s", f"{base}/g", D1, D2, fact_mode="append", load_seq=2)
    assert fact_of(spark, f"{base}/g") == [(D1, 1), (D1, 1), (D2, 1)]


def test_malformed_lines_are_counted_when_nothing_else_comes_through(spark, write_jsonl):
    root = write_jsonl("m/year=2024/month=01/day=01/a.jsonl.gz", [], raw_lines=['{"appid":1,"succ', "nonsense"])
    got = load_silver(spark, f"{root}/m", scratch_path(spark, "t_malformed"), D1, D1)
    assert got == {"game_daily": 0, "game_genre": 0, "game_category": 0, "game_company": 0, "malformed": 2}
