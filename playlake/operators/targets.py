"""Which ids to fetch next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_targets(active_ids: DataFrame, fetched_today: DataFrame) -> DataFrame:
    """Active ids not fetched yet today, as a set (always distinct).

    ``distinct`` and the anti join both key on appid, so the anti join reuses the
    distinct's partitioning; AQE broadcasts the fetched side when it is small.
    """
    active = active_ids.select(F.col("appid").cast("bigint").alias("appid")).where(F.col("appid").isNotNull())
    done = fetched_today.select(F.col("appid").cast("bigint").alias("appid")).where(F.col("appid").isNotNull())
    return active.distinct().join(done, "appid", "left_anti")


def full_load_targets(app_list: DataFrame, known: DataFrame) -> DataFrame:
    """Catalogue ids not known yet, as a list - duplicates kept, missing id -> 0."""
    apps = app_list.select(F.coalesce(F.col("appid").cast("bigint"), F.lit(0).cast("bigint")).alias("appid"))
    seen = known.select(F.col("appid").cast("bigint").alias("appid")).where(F.col("appid").isNotNull())
    return apps.join(seen, "appid", "left_anti")
