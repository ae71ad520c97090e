"""Segment sums kept by signed deltas equal the full views after changes of facts and of dims."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playlake.operators.growth import game_growth, genre_growth, publisher_growth
from playlake.operators.segment_state import dim_deltas, genre_view, growth_deltas, publisher_view
from playlake.plans.bindings import whole_fact_rows
from playlake.plans.medallion import maintain_growth, maintain_segments, read_growth, read_segments
from playlake.session import scratch_path
from playlake.sources.lake import drop_lost_days, write_fact

FACT = "snapshot_date date, appid bigint, recommendations_total bigint"
DIM = "appid bigint, genres array<string>, publishers array<string>"


def at(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("layout", ["date", "month"])
def test_facts_and_dims_change_in_turn(spark, layout):
    rng = random.Random(11)
    base = scratch_path(spark, "t_segments")
    make = lambda: [(at(d), a, rng.randrange(50)) for d in range(40) for a in range(8) if rng.random() < 0.8]
    lists = lambda: [(a, rng.sample(["A", "B", "C"], rng.randrange(3)), rng.choice((["P"], ["P", "P"], None))) for a in range(7)]
    rows, dim = make(), spark.createDataFrame(lists(), DIM)

    def keep(gone, come):
        for kind in ("genres", "publishers"):
            maintain_segments(spark, f"{base}/{kind}", growth_deltas(gone, come, dim, kind), layout)

    def load(part):
        write_fact(whole_fact_rows(spark.createDataFrame([r for r in rows if r[0] in part], FACT)), f"{base}/fact")
        drop_lost_days(spark, f"{base}/fact", {r[0] for r in rows}, at(0), at(99))

    def check():
        growth = game_growth(spark.createDataFrame(rows, FACT))
        assert rows_of(genre_view(read_segments(spark, f"{base}/genres"))) == rows_of(genre_growth(growth, dim))
        assert rows_of(publisher_view(read_segments(spark, f"{base}/publishers"))) == rows_of(publisher_growth(growth, dim))

    load({at(d) for d in range(40)})
    maintain_growth(spark, f"{base}/fact", f"{base}/growth", at(0), at(39), layout, keep)
    check()
    fresh = {at(5), at(6), at(20)}  # days that change, one of them to nothing
    rows = [r for r in rows if r[0] not in fresh] + [r for r in make() if r[0] in fresh - {at(6)}]
    load(fresh)
    assert maintain_growth(spark, f"{base}/fact", f"{base}/growth", at(5), at(20), layout, keep) == "repaired"
    check()
    before, dim = dim, spark.createDataFrame(lists(), DIM)
    for kind in ("genres", "publishers"):
        deltas = dim_deltas(read_growth(spark, f"{base}/growth"), before, dim, kind)
        maintain_segments(spark, f"{base}/{kind}", deltas, layout)
    check()
    rows += [(at(41), a, 7) for a in range(8)]
    load({at(41)})
    assert maintain_growth(spark, f"{base}/fact", f"{base}/growth", at(41), at(41), layout, keep) == "advanced"
    check()


def test_a_change_touches_its_dates_only(spark):
    base = scratch_path(spark, "t_segdates")
    growth = game_growth(spark.createDataFrame([(at(d), a, d) for d in range(6) for a in (1, 2)], FACT))
    dim = spark.createDataFrame([(1, ["A"], []), (2, ["A", "B"], [])], DIM)
    none = growth.where("false")
    maintain_segments(spark, base, growth_deltas(none, growth, dim, "genres"))
    files = lambda: set(spark.read.parquet(base).inputFiles())
    before = files()
    one = growth.where((F.col("appid") == 2) & (F.col("snapshot_date") == F.lit(at(3))))
    maintain_segments(spark, base, growth_deltas(one, none, dim, "genres"))
    assert {f.split("day=")[1][:10] for f in files() ^ before} == {at(3).isoformat()}
    assert rows_of(read_segments(spark, base).where(F.col("snapshot_date") == F.lit(at(3))).select("segment", "n")) == [("A", 1)]
    maintain_segments(spark, base, growth_deltas(none, none, dim, "genres"))
    maintain_segments(spark, base, dim_deltas(growth, dim, dim, "genres"))
    assert len(files()) == len(before)
