"""Bronze -> silver (D1, D2): filter, project, parse, dedup, bridge tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.functions.casts import UINT32, checked_cast
from playlake.functions.parse import (
    clean_age, list_field, minor_to_major, parse_fetched_at, parse_release_date, to_date_param,
)
from playlake.operators.dedup import latest_per_key
from playlake.schemas import SILVER_MAIN_COLUMNS

def clean_bronze(bronze: DataFrame, snapshot_date: _dt.date | str | None = None) -> DataFrame:
    """Successful bronze rows -> typed silver rows (with list columns).

    One ``select`` over the input (every expression sees the raw row, P2). The snapshot
    date is the day folder (``snapshot_date`` column of ``read_bronze``) unless given.
    Only contract columns leave this function (T12).
    """
    d = F.col("data")
    if snapshot_date is not None:
        day = F.lit(to_date_param(snapshot_date))
    else:
        day = F.col("snapshot_date")
    price_minor = d["price_overview"]["final"]
    return bronze.where(F.col("success")).select(
        checked_cast(F.col("appid"), "bigint", UINT32, "appid").alias("appid"),
        day.cast("date").alias("snapshot_date"),
        parse_fetched_at("fetched_at").alias("fetched_at"),
        d["type"].alias("type"),
        d["name"].alias("name"),
        parse_release_date(d["release_date"]["date"]).alias("release_date"),
        d["release_date"]["coming_soon"].alias("coming_soon"),
        clean_age(d["required_age"]).alias("required_age"),
        d["is_free"].cast("boolean").alias("is_free"),
        price_minor.alias("price_minor"),
        minor_to_major(price_minor).alias("price"),
        d["price_overview"]["currency"].alias("currency"),
        d["price_overview"]["discount_percent"].cast("bigint").alias("discount_percent"),
        F.coalesce(d["recommendations"]["total"].cast("bigint"), F.lit(0).cast("bigint")).alias(
            "recommendations_total"
        ),
        d["metacritic"]["score"].cast("bigint").alias("metacritic_score"),
        d["achievements"]["total"].cast("bigint").alias("achievements_total"),
        list_field(d["genres"]).alias("genres"),
        list_field(d["categories"]).alias("categories"),
        d["developers"].alias("developers"),
        d["publishers"].alias("publishers"),
    )


def dedup_snapshots(
    df: DataFrame,
    keys: tuple[str, ...] = ("appid", "snapshot_date"),
    time_col: str = "fetched_at",
    tiebreak: list[str] | None = None,
    null_time_wins: bool = True,
) -> DataFrame:
    """One row per (appid, snapshot_date), the latest fetch winning.

    Ties on the fetch time go to the smallest stable hash of the row (or to the
    ``tiebreak`` columns), so every run keeps the same winner. No global sort. T9: a
    descending sort puts NULL fetch times first, so by default an unparseable fetch time
    wins; without ``null_time_wins`` the latest parseable one does.
    """
    t = F.col(time_col)
    first = t.desc_nulls_first() if null_time_wins else t.desc_nulls_last()
    cols = tiebreak or [c for c in df.columns if c not in keys]
    tie = [F.col(c).asc_nulls_first() for c in tiebreak] if tiebreak else [F.xxhash64(*cols).asc()]
    return latest_per_key(df, list(keys), [first, *tie])


def silver_main(silver: DataFrame) -> DataFrame:
    """The main silver table drops the list columns."""
    return silver.select(*SILVER_MAIN_COLUMNS)


def _explode_list(silver: DataFrame, list_col: str, out_col: str) -> DataFrame:
    # Explode drops NULL and empty lists; NULL elements are removed after.
    return (
        silver.select("snapshot_date", "appid", F.explode(list_col).alias(out_col))
        .where(F.col(out_col).isNotNull())
    )


def genre_bridge(silver: DataFrame) -> DataFrame:
    """K2: one row per (day, game, genre); duplicates are kept (a bag, T15)."""
    return _explode_list(silver, "genres", "genre")


def category_bridge(silver: DataFrame) -> DataFrame:
    """K2: one row per (day, game, category); duplicates are kept."""
    return _explode_list(silver, "categories", "category")


def company_bridge(silver: DataFrame, one_row_per_day: bool = False) -> DataFrame:
    """Developers and publishers with their role, as a set.

    The same company in both roles gives two rows; a repeated name in one role, one. Both
    lists are stacked and exploded together, so the input is read once. ``distinct`` is a
    hash aggregate with map-side combine, so a hot company is reduced per task before the
    shuffle. With ``one_row_per_day`` (silver as the dedup leaves it) a name can only be repeated inside its
    own list, so each list is made a set where it is and nothing is shuffled.
    """
    lists = F.stack(F.lit(2), F.lit("developer"), F.col("developers"), F.lit("publisher"), F.col("publishers"))
    rows = silver.select("snapshot_date", "appid", lists.alias("role", "names"))
    names = F.array_distinct("names") if one_row_per_day else F.col("names")
    rows = rows.select("snapshot_date", "appid", F.explode(names).alias("company"), "role")
    rows = rows.where(F.col("company").isNotNull())
    return rows if one_row_per_day else rows.distinct()


def bronze_to_silver(bronze: DataFrame, snapshot_date=None) -> DataFrame:
    """D1 without the write: clean then dedup; keeps the list columns for the bridges."""
    cleaned = clean_bronze(bronze, snapshot_date)
    return dedup_snapshots(cleaned)


__all__ = [
    "bronze_to_silver", "category_bridge",
    "clean_bronze", "company_bridge", "dedup_snapshots", "genre_bridge", "silver_main",
]
