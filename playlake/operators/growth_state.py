"""Incremental game growth: carry each game's last snapshots, not its history.

The plain view recomputes every lag over the whole fact history. Here a tail table keeps,
per game, the rows of its last ``max(lags)`` snapshots. New days are stacked on the tail, the
same lag window runs over both, and only the new days' rows come out: lags still count
*snapshots back*, not days back (T2), with 0 past the first snapshot (T1). The next tail is
the end of both. The result equals ``game_growth`` over the full history
(tests/test_growth_state.py) as long as the new days follow the tail.

Days that change later reach forward through the lags: of each game with a row in such a day, now
or before, that day and its next ``max(lags)`` snapshots are recomputed (``changed_growth``);
rows of other games, and older and later rows of these, stay as they are.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.operators.growth import GROWTH_LAGS, game_growth

TAIL_COLUMNS = ["appid", "snapshot_date", "recommendations_total"]
TAIL_DDL = "appid bigint, snapshot_date date, recommendations_total bigint"


def next_tail(rows: DataFrame, lags: tuple[int, ...] = GROWTH_LAGS) -> DataFrame:
    """Each game's last ``max(lags)`` rows by day.

    ``row_number() <= keep`` plans a partial WindowGroupLimit, so a game's long history
    never crosses the shuffle whole.
    """
    w = Window.partitionBy("appid").orderBy(F.col("snapshot_date").desc(), F.col("recommendations_total").desc())
    ranked = rows.select(*TAIL_COLUMNS).withColumn("_rn", F.row_number().over(w))
    return ranked.where(F.col("_rn") <= max(lags)).drop("_rn")


def batch_growth(tail: DataFrame, batch: DataFrame, through: _dt.date | None, lags: tuple[int, ...] = GROWTH_LAGS) -> DataFrame:
    """The growth rows of ``batch``, whose days all follow ``through``, the tail's last day.

    One exchange on appid for tail and batch together; a game brings at most ``max(lags)``
    tail rows and one row per new day to its window.
    """
    growth = game_growth(tail.select(*TAIL_COLUMNS).unionByName(batch.select(*TAIL_COLUMNS)), lags=lags)
    return growth if through is None else growth.where(F.col("snapshot_date") > F.lit(through))


def changed_games(fact: DataFrame, before: DataFrame, changed: Column) -> DataFrame:
    """The games with a row in a changed day, in the fact as it is or in the growth rows as they were."""
    return fact.where(changed).select("appid").unionByName(before.where(changed).select("appid")).distinct()


def changed_growth(history: DataFrame, before: DataFrame, changed: Column, lags: tuple[int, ...] = GROWTH_LAGS) -> DataFrame:
    """The growth rows that differ, or may, since the days ``changed`` (a predicate on ``snapshot_date``) did.

    ``history`` holds the whole fact history of the games concerned (``changed_games``), ``before``
    the growth rows stored so far. A row is affected if it lies in a changed day, or fewer than
    ``max(lags)`` snapshots of its game lie between it and a changed day in which the game has, or
    had, a row. All rows of a game's day are affected together.
    """
    growth = game_growth(history, lags=lags).withColumn("_real", F.lit(True))
    lost = before.where(changed).select("snapshot_date", "appid").withColumn("_real", F.lit(False))
    rows = growth.unionByName(lost, allowMissingColumns=True).withColumn("_changed", changed)
    game = Window.partitionBy("appid")
    upto = game.orderBy("snapshot_date")  # a range frame: all rows of the day included
    real = F.count_if("_real")
    rows = rows.withColumn("_upto", real.over(upto)).withColumn("_same", real.over(Window.partitionBy("appid", "snapshot_date")))
    last = F.max(F.when(F.col("_changed"), F.col("_upto"))).over(upto)
    rows = rows.withColumn("_since", F.col("_upto") - F.col("_same") - last)
    hit = rows.where(F.col("_real") & (F.col("_changed") | (F.col("_since") < max(lags))))
    return hit.select(*growth.drop("_real").columns)
