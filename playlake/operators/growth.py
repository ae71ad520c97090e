"""Growth views (D5, D6, D7): row-based lags, then per-segment sums.

T1: a lag past the first snapshot is 0, not NULL, so a game's first growth is its
whole total. T2: lags count snapshots, not days - a gap stretches them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The view's lag distances in snapshots.
GROWTH_LAGS = (1, 7, 30)


def game_growth(
    fact: DataFrame,
    value_col: str = "recommendations_total",
    lags: tuple[int, ...] = GROWTH_LAGS,
    missing: str = "zero",
) -> DataFrame:
    """``value - lag(value, n)`` per game ordered by snapshot date.

    All lags share one window spec, so the plan has one Exchange (on appid), one Sort
    and one Window node. ``missing='null'`` gives NULL past the first snapshot instead
    of the parity default 0. A game's rows are one per snapshot day, so the window
    partition of even the hottest game is bounded by the number of days kept.
    """
    if missing not in ("zero", "null"):
        raise ValueError("missing must be 'zero' or 'null'")
    v = F.col(value_col)
    # The value orders twin rows of one day (an appended re-load), so runs repeat.
    w = Window.partitionBy("appid").orderBy("snapshot_date", value_col)
    growth = [
        (v - (F.lag(v, n, 0) if missing == "zero" else F.lag(v, n)).over(w)).alias(f"rec_growth_{n}d")
        for n in lags
    ]
    return fact.select("snapshot_date", "appid", v.alias("recommendations_total"), *growth)


def segment_growth(growth: DataFrame, dim: DataFrame, list_col: str, segment: str,
                   aggregates: dict[str, tuple[str, str]]) -> DataFrame:
    """Explode a dim list, join to growth, aggregate.

    The list is exploded on the dim side first (inner: games with no dim row or an
    empty list drop out), so the join carries (appid, segment) pairs only. The growth
    side is already hash-partitioned by appid from its window, so only the dim side
    moves - or nothing, when AQE sees it small enough to broadcast. The final
    ``groupBy`` aggregates partially before its shuffle, so a hot segment costs one
    row per task.
    """
    pairs = dim.select("appid", F.explode(list_col).alias(segment))
    joined = growth.join(pairs, "appid", "inner")
    aggs = [getattr(F, fn)(src).alias(name) for name, (fn, src) in aggregates.items()]
    return joined.groupBy("snapshot_date", segment).agg(*aggs)


def genre_growth(growth: DataFrame, dim: DataFrame) -> DataFrame:
    """Per (snapshot_date, genre) sums of 1- and 7-snapshot growth and mean total."""
    return segment_growth(growth, dim, "genres", "genre", {
        "genre_growth_1d": ("sum", "rec_growth_1d"),
        "genre_growth_7d": ("sum", "rec_growth_7d"),
        "avg_recommendations": ("avg", "recommendations_total"),
    })


def publisher_growth(growth: DataFrame, dim: DataFrame) -> DataFrame:
    """Per (snapshot_date, publisher) sums of 1- and 7-snapshot growth."""
    return segment_growth(growth, dim, "publishers", "publisher", {
        "pub_growth_1d": ("sum", "rec_growth_1d"),
        "pub_growth_7d": ("sum", "rec_growth_7d"),
    })
