"""Gold dealt by game (J2, J3, K10): fact and newest dim in the same buckets of ``appid``.

The growth window and the dim join both go by game. Over the date-ordered fact each view moves all of
it to its games; over these tables bucket i of the fact meets bucket i of the dim where they lie, and
only the final sums are shuffled. They are a copy for reading: ``refresh_by_game`` rewrites the
months of a load and the dim, so the fact stays the table that is loaded, replaced by day and read by date.

The number of buckets is part of a table's folder, because readers must name the one it was
written with. A bucket holds all rows of its games, so choose as many as make a month of one a file
of some 100 MB. A game has a row a day, so no game outweighs its bucket.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions.parse import to_date_param, year_month
from playlake.operators.gold import latest_dim
from playlake.schemas import DIM_COLUMNS, DIM_DDL, FACT_COLUMNS, FACT_DDL
from playlake.sources.lake import DIM_TABLE, FACT_TABLE, _delete_path, _path_exists, read_dim_log, read_fact, table_path
from playlake.sources.paths import month_folders

BUCKETS = 64


def by_game_path(gold_root: str, table: str, buckets: int) -> str:
    return f"{gold_root.rstrip('/')}/by_game_{buckets}/{table}"


def _declared(spark: SparkSession, gold_root: str, table: str, buckets: int) -> str:
    """The bucketed table declared anew in the session's catalog over its folder; the name it has there."""
    path = by_game_path(gold_root, table, buckets)
    name = f"by_game_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # the declaration only: the table is external
    ddl, folders, order = (DIM_DDL, "", "appid") if table == DIM_TABLE else (
        FACT_DDL + ", snapshot_month int", "PARTITIONED BY (snapshot_month)", "appid, snapshot_date")
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({ddl}) USING parquet {folders} "
        f"CLUSTERED BY (appid) SORTED BY ({order}) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
    )
    if folders and _path_exists(spark, path):
        spark.catalog.recoverPartitions(name)
    return name


def refresh_by_game(spark: SparkSession, gold_root: str, start=None, end=None, buckets: int = BUCKETS) -> None:
    """Bring the copy up to date after a load of ``[start, end]`` (open ends: all days).

    The months of the range are rewritten whole, as they are in the fact; one that has no rows there any
    more loses its folder once the others are written. The dim is rewritten as the newest version of each
    game. A run that failed is run again. Each write moves its rows once, into as many tasks as there are
    buckets, so a month of a bucket is one file.
    """
    first = start and to_date_param(start).replace(day=1)
    last = end and (to_date_param(end).replace(day=28) + _dt.timedelta(days=4)).replace(day=1) - _dt.timedelta(days=1)
    fact = read_fact(spark, table_path(gold_root, FACT_TABLE), first, last).withColumn(
        "snapshot_month", year_month("snapshot_date"))
    held = {r[0] for r in fact.select("snapshot_month").distinct().collect()}  # calendar months
    if held:
        _insert(fact.select(*FACT_COLUMNS, "snapshot_month"), gold_root, FACT_TABLE, buckets)
    path = by_game_path(gold_root, FACT_TABLE, buckets)
    for folder in month_folders(spark, path, first or _dt.date.min, last or _dt.date.max):
        if int(folder.rstrip("/")[-6:]) not in held:
            _delete_path(spark, folder)
    dim = latest_dim(read_dim_log(spark, table_path(gold_root, DIM_TABLE)))
    _insert(dim.select(*DIM_COLUMNS), gold_root, DIM_TABLE, buckets)


def _insert(rows: DataFrame, gold_root: str, table: str, buckets: int) -> None:
    name = _declared(rows.sparkSession, gold_root, table, buckets)
    dealt = rows.repartition(buckets, "appid")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(name)


def read_by_game(spark: SparkSession, gold_root: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """The fact and the newest dim as bucketed tables, in contract column order."""
    if not _path_exists(spark, by_game_path(gold_root, DIM_TABLE, buckets)):
        raise ValueError(f"{gold_root} holds no copy in {buckets} buckets: refresh_by_game writes it")
    fact, dim = (spark.table(_declared(spark, gold_root, t, buckets)) for t in (FACT_TABLE, DIM_TABLE))
    return fact.select(*FACT_COLUMNS), dim.select(*DIM_COLUMNS)
