"""Silver and gold parquet tables.

Layouts:

* silver tables: ``<root>/<table>/snapshot_date=YYYY-MM-DD/`` - one folder per day,
  rewritten per day with dynamic partition overwrite.
* gold fact: ``<root>/fact_game_daily/snapshot_month=YYYYMM/snapshot_date=YYYY-MM-DD/`` -
  the reference's monthly partition key with a folder per day inside, so a day is replaced
  without touching its month. Append-only tables may keep whole months in one folder
  (``layout="month"``), which spares a multi-year load thousands of folders. Rows are sorted
  by (snapshot_date, appid) inside each file, so row-group statistics prune either way.
* gold dim: an append-only version log with a folder per load, read back through ``latest_dim``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions.parse import to_date_param, year_month
from playlake.sources.observe import counted, rows_of
from playlake.sources.paths import date_folders, fact_days, month_folders, no_such_path
from playlake.session import scratch_path
from playlake.schemas import (
    CATEGORY_DDL, COMPANY_DDL, DIM_LOG_DDL, FACT_COLUMNS, FACT_DDL, GENRE_DDL,
    SILVER_MAIN_DDL, TABLE_DDL,
)

SILVER_TABLES = {
    "game_daily": SILVER_MAIN_DDL,
    "game_genre": GENRE_DDL,
    "game_category": CATEGORY_DDL,
    "game_company": COMPANY_DDL,
}
KEPT_TABLE = "game_kept"  # beside the four, where late files are merged (``merge_silver``)
FACT_TABLE = "fact_game_daily"
TABLE_PARTITIONS = {
    "game_daily": ["snapshot_date"],
    "game_genre": ["snapshot_date"],
    "game_category": ["snapshot_date"],
    "game_company": ["snapshot_date"],
    "fact_game_daily": ["snapshot_month", "snapshot_date"],
    "dim_game": ["load_seq"],
}
DIM_TABLE = "dim_game"
GOLD_TABLES = (FACT_TABLE, DIM_TABLE)


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def write_day_partitions(df: DataFrame, path: str, date_col: str = "snapshot_date") -> int:
    """K1/K2: replace exactly the days present in ``df``; other days stay untouched.

    Returns the rows written (counted inside the write job, K11).
    """
    df, obs = counted(df)
    (
        df.hint("rebalance", date_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(date_col)
        .parquet(path)
    )
    return rows_of(obs)


def drop_days(spark: SparkSession, path: str, days, date_col: str = "snapshot_date") -> None:
    """Remove the folders of ``days`` (dates of a load, at most one per calendar day)."""
    for day in days:
        _delete_path(spark, f"{path.rstrip('/')}/{date_col}={day.isoformat()}")


def drop_lost_days(spark: SparkSession, path: str, held, start: _dt.date, end: _dt.date) -> list[_dt.date]:
    """Remove the stored days of ``[start, end]`` that are not in ``held``, from a table with a folder
    per day (inside month folders or not). Returns the days removed."""
    stored = fact_days(spark, path, start, end)
    stored |= {_dt.date.fromisoformat(p.rstrip("/")[-10:]): p for p in date_folders(spark, path, start, end)}
    lost = sorted(set(stored) - set(held))
    for day in lost:
        _delete_path(spark, stored[day])
    return lost


def read_table(
    spark: SparkSession,
    path: str,
    ddl: str,
    start: _dt.date | str | None = None,
    end: _dt.date | str | None = None,
    date_col: str = "snapshot_date",
    layout: str | None = None,
) -> DataFrame:
    """A parquet table pruned to ``[start, end]``; absent table -> empty frame.

    ``layout`` names the folder scheme (``"date"``: ``snapshot_date=``, ``"month"``:
    ``snapshot_month=``). For a bounded range only the folders of the range are listed
    and read, so the listing grows with the range rather than the table's history.
    """
    paths: list[str] = [path]
    if start is not None and end is not None and layout is not None:
        s, e = to_date_param(start), to_date_param(end)
        finder = date_folders if layout == "date" else month_folders
        paths = finder(spark, path, s, e)
        if not paths:
            return spark.createDataFrame([], ddl)
    try:
        df = spark.read.schema(ddl).option("basePath", path).parquet(*paths)
    except AnalysisException as err:
        if no_such_path(err):
            return spark.createDataFrame([], ddl)
        raise
    if start is not None:
        df = df.where(F.col(date_col) >= F.lit(to_date_param(start)))
    if end is not None:
        df = df.where(F.col(date_col) <= F.lit(to_date_param(end)))
    return df


def read_silver(spark: SparkSession, root: str, table: str, start=None, end=None) -> DataFrame:
    return read_table(spark, table_path(root, table), SILVER_TABLES[table], start, end, layout="date")


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def _delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


#: Folder schemes of the fact: whole months for append-only tables, a folder per day inside the
#: month for tables whose days get replaced.
LAYOUTS = {"month": ["snapshot_month"], "date": ["snapshot_month", "snapshot_date"]}


def write_by_month(
    df: DataFrame, path: str, columns: list[str], mode: str = "replace_date", layout: str = "date", clustered: bool = False
) -> int:
    """Month folders, rows sorted by (snapshot_date, appid); append or replace whole days.

    ``replace_date`` (date layout only): every snapshot date present in ``df`` is replaced
    whole by dynamic partition overwrite, other days are neither read nor written, and a job
    that fails leaves the old days in place. Returns the rows loaded (K11), counted inside
    the write job. ``rebalance`` sizes the files and splits a hot day over several; each of those
    holds ids from the whole range, so a filter on one game reads them all. ``clustered`` deals the
    rows by ranges of (day, appid) instead, whose bounds Spark samples in a pass of its own: files of a
    day then hold ranges of ids that do not overlap, and a game lies in one of them.
    """
    if mode not in ("replace_date", "append"):
        raise ValueError(f"unknown load mode {mode!r}")
    if mode == "replace_date" and layout != "date":
        raise ValueError("replacing days needs the date layout")
    folders = LAYOUTS[layout]
    rows = df.select(*columns).withColumn("snapshot_month", year_month("snapshot_date"))
    if clustered:  # counted behind the exchange, as sampling its bounds runs what is before it once more
        dealt, obs = counted(rows.repartitionByRange(*folders, "snapshot_date", "appid"))
    else:
        rows, obs = counted(rows)
        dealt = rows.hint("rebalance", *folders)
    (
        dealt.sortWithinPartitions(*folders, "snapshot_date", "appid")
        .write.mode("append" if mode == "append" else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*folders)
        .parquet(path)
    )
    return rows_of(obs)


def write_fact(fact: DataFrame, path: str, mode: str = "replace_date", layout: str = "date", clustered: bool = False) -> int:
    """Load fact rows into month folders sorted by (snapshot_date, appid).

    ``append``: rows are added (a re-run duplicates them, as the reference's loader
    does). ``replace_date`` (default, T3): every snapshot date in ``fact`` is replaced
    whole, so a re-run gives the same rows (see ``write_by_month``). A table keeps the
    layout it was created with. ``clustered``: files of a day do not overlap in ``appid``.
    """
    return write_by_month(fact, path, FACT_COLUMNS, mode, layout, clustered)


def read_fact(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """The fact table in contract column order (the month folder is a layout detail)."""
    ddl = FACT_DDL + ", snapshot_month int"
    return read_table(spark, path, ddl, start, end, layout="month").select(*FACT_COLUMNS)


def replace_fact_date(fact: DataFrame, path: str, day: _dt.date | str) -> int:
    """Delete one snapshot date and insert the given rows for it.

    Raises when no date is given, like the reference; rows for other dates are refused. No
    rows for the date leave it empty. Only that day's folder is written.
    """
    if day is None:
        raise ValueError("replace_fact_date needs a snapshot date")
    d = to_date_param(day)
    checked = fact.withColumn(
        "snapshot_date",
        F.when(F.col("snapshot_date") == F.lit(d), F.col("snapshot_date")).otherwise(
            F.raise_error(F.lit(f"row outside snapshot date {d}"))
        ).cast("date"),
    )
    rows = write_fact(checked, path, mode="replace_date")
    if not rows:
        _delete_path(fact.sparkSession, f"{path.rstrip('/')}/snapshot_month={d:%Y%m}/snapshot_date={d.isoformat()}")
    return rows


def append_dim_versions(dim: DataFrame, path: str, load_seq: int) -> int:
    """K8: append one load's dim rows to the version log (never overwrite the dim, T31).

    Every load is a folder of its own. Returns the versions appended (counted inside the
    write job).
    """
    dim, obs = counted(dim)
    (
        dim.withColumn("load_seq", F.lit(load_seq).cast("bigint"))
        .write.mode("append")
        .option("compression", "snappy")
        .partitionBy("load_seq")
        .parquet(path)
    )
    return rows_of(obs)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().toString() for st in (fs.globStatus(jpath) or []))


def read_dim_log(spark: SparkSession, path: str) -> DataFrame:
    """Every version of the log."""
    return read_table(spark, path, DIM_LOG_DDL)


def compact_dim_log(spark: SparkSession, path: str) -> int:
    """K8: thin the version log out to the newest version of each game.

    The log grows by one version per game per load; without the superseded ones, reads of
    the latest dim stay proportional to the catalogue. Each load's folder is overwritten with
    its rows that are still the newest (same order as ``latest_dim``); a load that has none left
    loses its folder. What ``latest_dim`` gives never changes, whenever this stops, and loads
    appended meanwhile are not touched. Returns the versions kept.
    """
    from playlake.operators.gold import newest_versions

    log = read_dim_log(spark, path)
    loads = {r.load_seq for r in log.select("load_seq").distinct().collect()}  # one per load
    if not loads:
        return 0
    staged = scratch_path(spark, "dim_newest")
    newest_versions(log).write.parquet(staged)  # what is overwritten must not be read meanwhile
    newest, obs = counted(spark.read.schema(DIM_LOG_DDL).parquet(staged))
    (
        newest.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("load_seq")
        .parquet(path)
    )
    left = {r.load_seq for r in spark.read.schema(DIM_LOG_DDL).parquet(staged).select("load_seq").distinct().collect()}
    for seq in loads - left:
        _delete_path(spark, f"{path.rstrip('/')}/load_seq={seq}")
    return rows_of(obs)


def ensure_tables(spark: SparkSession, root: str, tables: tuple[str, ...] = tuple(TABLE_DDL)) -> list[str]:
    """K9: create every table of ``tables`` under ``root`` that does not exist yet, empty and typed.

    Returns the tables that were created. Existing tables are left alone.
    """
    created = []
    for table in tables:
        path = table_path(root, table)
        if _path_exists(spark, path):
            continue
        ddl = FACT_DDL + ", snapshot_month int" if table == FACT_TABLE else TABLE_DDL[table]
        writer = spark.createDataFrame([], ddl).write.mode("errorifexists")
        if table in TABLE_PARTITIONS:
            writer = writer.partitionBy(*TABLE_PARTITIONS[table])
        writer.parquet(path)
        created.append(table)
    return created


def table_contract(spark: SparkSession, root: str, tables: tuple[str, ...] = tuple(TABLE_DDL)) -> DataFrame:
    """K9: (table, column, type) of every table as stored, read from files' footers and folders.

    A table that is not there gives one row without column and type. One that holds no rows
    yet has no file to read; readers apply the declared types, and so does this, also for the columns
    that are folder names and have no type of their own.
    """
    rows: list[tuple] = []
    for table in tables:
        path = table_path(root, table)
        if not _path_exists(spark, path):
            rows.append((table, None, None))
            continue
        try:
            schema = spark.read.parquet(path).schema
        except AnalysisException as err:
            if err.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            schema = spark.createDataFrame([], TABLE_DDL[table]).schema
        declared = {f.name: f.dataType for f in spark.createDataFrame([], TABLE_DDL[table]).schema.fields}
        in_path = {c: declared[c] for c in TABLE_PARTITIONS.get(table, []) if c in declared}
        rows += [(table, f.name, in_path.get(f.name, f.dataType).simpleString()) for f in schema.fields]
    return spark.createDataFrame(rows, "table string, column string, type string")
