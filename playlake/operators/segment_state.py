"""Segment views kept up to date by signed deltas.

What is stored per (date, segment) can be added and taken away: two growth sums, the sum of totals and the
number of rows, from which the mean follows. A change of growth rows, or of the lists a game has
in the dim, is a bag of rows that go (sign -1) and rows that come (+1); summed per (date, segment)
it is added to what is stored. Segments of other dates and games are neither read nor recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATE_DDL = "snapshot_date date, segment string, growth_1d bigint, growth_7d bigint, total bigint, n bigint"
KEYS = ["snapshot_date", "segment"]
SUMS = ["growth_1d", "growth_7d", "total", "n"]


def _signed(growth: DataFrame, pairs: DataFrame, sign: int) -> DataFrame:
    amount = lambda c, name: (F.col(c) * sign).alias(name)
    return growth.join(pairs, "appid").select(
        "snapshot_date", "segment", amount("rec_growth_1d", "growth_1d"), amount("rec_growth_7d", "growth_7d"),
        amount("recommendations_total", "total"), F.lit(sign).cast("bigint").alias("n"))


def _pairs(dim: DataFrame, list_col: str) -> DataFrame:
    return dim.select("appid", F.explode(list_col).alias("segment"))


def _summed(rows: DataFrame) -> DataFrame:
    """Sums per (date, segment), added up map-side first, without those in which nothing is left."""
    sums = rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])
    return sums.where(" OR ".join(f"{c} <> 0" for c in SUMS))


def growth_deltas(gone: DataFrame, come: DataFrame, dim: DataFrame, list_col: str) -> DataFrame:
    """What growth rows that go and growth rows that come change in the segments of ``dim``."""
    pairs = _pairs(dim, list_col)
    return _summed(_signed(gone, pairs, -1).unionByName(_signed(come, pairs, 1)))


def dim_deltas(growth: DataFrame, before: DataFrame, after: DataFrame, list_col: str) -> DataFrame:
    """What new dim versions change: only (game, segment) pairs that differ meet the growth rows.

    A segment a list holds twice counts twice, before and after.
    """
    old, new = _pairs(before, list_col), _pairs(after, list_col)
    gone, come = old.exceptAll(new), new.exceptAll(old)
    return _summed(_signed(growth, gone, -1).unionByName(_signed(growth, come, 1)))


def added(state: DataFrame, deltas: DataFrame) -> DataFrame:
    """The state with the deltas in it; a segment whose last row has gone is gone."""
    return _summed(state.select(*KEYS, *SUMS).unionByName(deltas.select(*KEYS, *SUMS))).where("n <> 0")


def genre_view(state: DataFrame) -> DataFrame:
    """D6 from the state."""
    return state.select(
        "snapshot_date", F.col("segment").alias("genre"), F.col("growth_1d").alias("genre_growth_1d"),
        F.col("growth_7d").alias("genre_growth_7d"), (F.col("total") / F.col("n")).alias("avg_recommendations"))


def publisher_view(state: DataFrame) -> DataFrame:
    """D7 from the state."""
    return state.select(
        "snapshot_date", F.col("segment").alias("publisher"), F.col("growth_1d").alias("pub_growth_1d"),
        F.col("growth_7d").alias("pub_growth_7d"))
