"""Date-range medallion jobs (D1-D4, D11, D12) and the gold views.

Each layer is one Spark job over the whole range, not one process per date:
partition pruning picks the days, dynamic partition overwrite replaces exactly
the days present, and each written table cuts the lineage for the next layer
(so a lost executor only recomputes from the last written layer).
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from playlake.functions.parse import date_range, to_date_param, year_month
from playlake.operators.gold import build_dim, build_fact, latest_dim, range_problems
from playlake.operators.growth import game_growth, genre_growth, publisher_growth
from playlake.operators.growth_state import (
    TAIL_COLUMNS, TAIL_DDL, batch_growth, changed_games, changed_growth, next_tail,
)
from playlake.operators.segment_state import STATE_DDL, added
from playlake.operators.silver import (
    bronze_to_silver, category_bridge, company_bridge, dedup_snapshots, genre_bridge, silver_main,
)
from playlake.schemas import BRONZE_DDL, GROWTH_COLUMNS, SILVER_KEPT_DDL
from playlake.session import scratch_path
from playlake.sources.by_game import read_by_game
from playlake.sources.bronze import CORRUPT, malformed_lines, read_bronze
from playlake.sources.lake import (
    DIM_TABLE, FACT_TABLE, GOLD_TABLES, KEPT_TABLE, SILVER_TABLES, _delete_path, _glob, _path_exists, append_dim_versions, drop_days, drop_lost_days, ensure_tables,
    read_dim_log, read_fact, read_silver, read_table, table_path, write_day_partitions, write_fact,
)
from playlake.sources.observe import metric
from playlake.sources.paths import date_folders, day_folders, day_runs, folder_day

GROWTH_DDL = (
    "snapshot_date date, appid bigint, recommendations_total bigint, "
    "rec_growth_1d bigint, rec_growth_7d bigint, rec_growth_30d bigint"
)


def run_concurrently(jobs: list) -> list:
    """Submit independent Spark jobs (e.g. writes of different tables) at the same time.

    Each write is its own job with its own commit; submitting them together lets the
    scheduler fill idle slots with the other writes' tasks. Any failure is re-raised.
    Returns the jobs' results in order.
    """
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [fut.result() for fut in [pool.submit(job) for job in jobs]]


def load_silver(spark: SparkSession, bronze_root: str, silver_root: str, start, end, keep_state: bool = False) -> dict[str, int]:
    """D1+D2: bronze days in ``[start, end]`` -> the four silver tables.

    The cleaned, deduplicated rows are staged once as a table in the shared folder; the four
    tables are written from it, so a lost executor re-reads parquet and never re-parses
    bronze. Every day that has bronze files is replaced in all four tables: a day whose
    re-run gives a table no rows loses that table's folder, after the writes have
    committed. Days without bronze files stay as they are (T24: skipped, not failed).
    ``keep_state`` stores the staged rows too, as what ``merge_silver`` merges late files into; a silver
    root that has them keeps them up to date with every load.
    Returns the rows written per silver table and ``malformed``, the bronze lines that are
    no JSON record.
    """
    landed = [folder_day(p) for p in day_folders(spark, bronze_root, to_date_param(start), to_date_param(end))]
    bronze = read_bronze(spark, bronze_root, start, end, schema=f"{BRONZE_DDL}, {CORRUPT} string")
    lines = Observation(f"lines-{uuid.uuid4().hex[:8]}")
    bronze = bronze.observe(lines, F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"))
    staging = scratch_path(spark, "silver_staging")
    bronze_to_silver(bronze).write.parquet(staging)
    counts = _replace_silver_days(spark, spark.read.parquet(staging), silver_root, landed, keep_state)
    _delete_path(spark, staging)
    malformed = metric(lines, "malformed") if landed else 0
    if malformed is None:  # no row came through, and the count with it: count alone
        malformed = malformed_lines(spark, bronze_root, start, end).agg(F.sum("n_malformed")).first()[0] or 0
    return counts | {"malformed": int(malformed)}


def _replace_silver_days(spark: SparkSession, silver: DataFrame, silver_root: str, days, keep_state: bool) -> dict[str, int]:
    """The deduplicated rows of whole ``days`` (a stored table) as the silver tables' new content of them."""
    some = lambda c: F.max(F.exists(F.coalesce(c, F.array()), lambda x: x.isNotNull()))
    held = silver.groupBy("snapshot_date").agg(
        F.lit(True).alias("game_daily"),
        some("genres").alias("game_genre"),
        some("categories").alias("game_category"),
        F.greatest(some("developers"), some("publishers")).alias("game_company"),
        F.lit(True).alias(KEPT_TABLE),
    ).collect()  # one row per day of the range
    tables = {"game_daily": silver_main, "game_genre": genre_bridge,
              "game_category": category_bridge, "game_company": partial(company_bridge, one_row_per_day=True)}
    if keep_state or _path_exists(spark, table_path(silver_root, KEPT_TABLE)):
        tables[KEPT_TABLE] = lambda rows: rows

    def write(table: str) -> int:
        path = table_path(silver_root, table)
        full = {r.snapshot_date for r in held if r[table]}
        rows = write_day_partitions(tables[table](silver), path) if full else 0
        drop_days(spark, path, set(days) - full)
        return rows

    return dict(zip(tables, run_concurrently([lambda t=t: write(t) for t in tables])))


def merge_silver(spark: SparkSession, late: DataFrame, bronze_root: str, silver_root: str) -> dict[str, int]:
    """Bronze rows of new files merged into the silver days they belong to.

    ``late`` holds the rows of the new files, with ``snapshot_date``. Of the row kept so far and the new
    ones the dedup keeps the same row as of all of the day's files, as its order is total; so only the
    new files are parsed, and the kept rows of these days are read as parquet. A day without kept
    rows (new, all failures so far, or loaded without ``keep_state``) is loaded from its bronze folder, which
    must hold the new files too. A batch merged again changes nothing, so a run that failed is run
    again. Rows whose day is null belong to no day and are left out.
    Returns the rows now stored per silver table in the days merged or loaded.
    """
    path = table_path(silver_root, KEPT_TABLE)
    touched = {r[0] for r in late.select("snapshot_date").distinct().collect()} - {None}  # calendar days
    kept = {_dt.date.fromisoformat(p.rstrip("/")[-10:]) for p in date_folders(spark, path, _dt.date.min, _dt.date.max)}
    loads = [load_silver(spark, bronze_root, silver_root, *run, keep_state=True) for run in day_runs(sorted(touched - kept))]
    if touched & kept:
        staging, merged = scratch_path(spark, "silver_late"), scratch_path(spark, "silver_merged")
        bronze_to_silver(late.where(F.col("snapshot_date").isin(sorted(touched & kept)))).write.parquet(staging)
        new = spark.read.parquet(staging)
        days = sorted(r[0] for r in new.select("snapshot_date").distinct().collect())
        if days:
            state = read_table(spark, path, SILVER_KEPT_DDL, days[0], days[-1], layout="date")
            state = state.where(F.col("snapshot_date").isin(days)).select(*new.columns)
            dedup_snapshots(state.unionByName(new)).write.parquet(merged)
            loads.append(_replace_silver_days(spark, spark.read.parquet(merged), silver_root, days, True))
            _delete_path(spark, merged)
        _delete_path(spark, staging)
    return {table: sum((load[table] for load in loads), 0) for table in (*SILVER_TABLES, KEPT_TABLE)}


def load_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    start,
    end,
    fact_mode: str = "replace_date",
    updated_at=None,
    load_seq: int | None = None,
    out_of_range: str = "fail",
    version_by: str = "updated_at",
    clustered: bool = False,
) -> dict[str, int] | None:
    """D3+D4+D12: silver days in ``[start, end]`` -> fact rows and one dim version per game.

    The gold tables are created first where they do not exist. A row whose value does not fit
    its gold type fails the load, or with ``out_of_range="quarantine"`` goes to
    ``<gold>/quarantine`` with the names of its columns while the others load (T16).
    Gold follows silver: once the writes have committed, a day of the range that has no such
    rows any more loses its folder, in the fact (when days are replaced) and in the quarantine.
    ``clustered`` writes the fact so that a filter on a game reads one file of a day (``write_by_month``).
    Returns the rows loaded per gold table, or None (nothing loaded) when the range has no
    silver rows; where there is no silver table at all nothing is removed.
    """
    if out_of_range not in ("fail", "quarantine"):
        raise ValueError("out_of_range must be 'fail' or 'quarantine'")
    if fact_mode not in ("replace_date", "append"):
        raise ValueError(f"unknown load mode {fact_mode!r}")
    ensure_tables(spark, gold_root, GOLD_TABLES)
    if not _path_exists(spark, table_path(silver_root, "game_daily")):
        return None
    main = read_silver(spark, silver_root, "game_daily", start, end)
    flagged = main.withColumn("out_of_range", range_problems(main) if out_of_range == "quarantine" else F.array())
    held = flagged.groupBy("snapshot_date").agg(
        F.bool_or(F.size("out_of_range") == 0).alias("good"), F.bool_or(F.size("out_of_range") > 0).alias("bad")
    ).collect()  # one row per day of the range
    first, last = to_date_param(start, _dt.date.min), to_date_param(end, _dt.date.max)
    fact_path, quarantine = table_path(gold_root, FACT_TABLE), f"{gold_root.rstrip('/')}/quarantine"

    def follow() -> None:
        if fact_mode == "replace_date":
            drop_lost_days(spark, fact_path, {r.snapshot_date for r in held if r.good}, first, last)
        drop_lost_days(spark, quarantine, {r.snapshot_date for r in held if r.bad}, first, last)

    if not held:
        follow()
        return None
    genres = read_silver(spark, silver_root, "game_genre", start, end)
    categories = read_silver(spark, silver_root, "game_category", start, end)
    companies = read_silver(spark, silver_root, "game_company", start, end)
    loaded: dict[str, int] = {}
    if out_of_range == "quarantine":
        loaded["quarantine"] = 0
        if any(r.bad for r in held):
            loaded["quarantine"] = write_day_partitions(flagged.where(F.size("out_of_range") > 0), quarantine)
        main = flagged.where(F.size("out_of_range") == 0).drop("out_of_range")
    dim = build_dim(main, genres, categories, companies, updated_at=updated_at, version_by=version_by)
    seq = load_seq if load_seq is not None else time.time_ns() // 1000
    fact_rows, dim_rows = run_concurrently([
        lambda: write_fact(build_fact(main), fact_path, mode=fact_mode, clustered=clustered),
        lambda: append_dim_versions(dim, table_path(gold_root, DIM_TABLE), seq),
    ])
    follow()
    return {FACT_TABLE: fact_rows, DIM_TABLE: dim_rows} | loaded


def run_range(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str,
    start: _dt.date | str,
    end: _dt.date | str,
    fact_mode: str = "replace_date",
    updated_at=None,
    load_seq: int | None = None,
) -> DataFrame:
    """Backfill silver then gold for an inclusive date range (both ends required, T25).

    Returns one report row per requested day: ``snapshot_date, silver_rows, status``
    where ``status`` is ``loaded`` or ``skipped`` (no bronze for that day, T24).
    """
    s, e = to_date_param(start), to_date_param(end)
    if e < s:
        raise ValueError(f"end {e} before start {s}")
    load_silver(spark, bronze_root, silver_root, s, e)
    load_gold(spark, silver_root, gold_root, s, e, fact_mode, updated_at, load_seq)
    return range_report(spark, silver_root, s, e)


def range_report(spark: SparkSession, silver_root: str, start, end) -> DataFrame:
    """Per requested day: silver rows written and loaded/skipped."""
    s, e = to_date_param(start), to_date_param(end)
    days = spark.range(1).select(F.explode(date_range(F.lit(s), F.lit(e))).alias("snapshot_date"))
    counts = (
        read_silver(spark, silver_root, "game_daily", s, e)
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = F.coalesce(F.col("n"), F.lit(0).cast("bigint"))
    return days.join(counts, "snapshot_date", "left").select(
        "snapshot_date",
        rows.alias("silver_rows"),
        F.when(rows > 0, F.lit("loaded")).otherwise(F.lit("skipped")).alias("status"),
    )


def gold_views(
    spark: SparkSession, gold_root: str, growth_path: str | None = None, buckets: int | None = None
) -> dict[str, DataFrame]:
    """D5-D7 over the stored gold tables; the dim is always the collapsed latest version.

    With ``growth_path`` (the table ``maintain_growth`` keeps) the game view reads the
    materialized growth rows instead of re-running the window over the whole fact: a
    ``snapshot_date`` filter then reaches the parquet scan (rows are sorted by date, so
    row groups are skipped), which it cannot do through a window. With ``buckets`` fact and
    dim are read from the copy ``refresh_by_game`` keeps, where window and join move nothing.
    """
    if buckets is not None:
        fact, dim = read_by_game(spark, gold_root, buckets)
    else:
        dim = latest_dim(read_dim_log(spark, table_path(gold_root, DIM_TABLE)))
    if growth_path is not None:
        growth = read_growth(spark, growth_path)
    elif buckets is not None:
        growth = game_growth(fact)
    else:
        growth = game_growth(read_fact(spark, table_path(gold_root, FACT_TABLE)))
    return {
        "view_game_growth": growth,
        "view_genre_growth": genre_growth(growth, dim),
        "view_publisher_growth": publisher_growth(growth, dim),
    }


def register_views(
    spark: SparkSession, gold_root: str, growth_path: str | None = None, buckets: int | None = None
) -> list[str]:
    """K9: expose the three views to SQL as temp views."""
    views = gold_views(spark, gold_root, growth_path, buckets)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)


def _growth_folder(layout: str) -> tuple[str, Column]:
    """The partition column of a stored growth table and its value."""
    if layout not in ("date", "month"):
        raise ValueError(f"unknown layout {layout!r}")
    return ("day", F.col("snapshot_date")) if layout == "date" else ("month", year_month("snapshot_date"))


def read_growth(spark: SparkSession, growth_path: str, start=None, end=None) -> DataFrame:
    """The materialized growth rows, optionally of ``[start, end]``: up to the last day taken in, so that
    those of a run that failed before its tail do not show."""
    through = _tail_day(spark, growth_path)
    if through is None:
        return spark.createDataFrame([], GROWTH_DDL)
    end = min(to_date_param(end, through), through)
    return _stored_growth(spark, growth_path).where(_between(start, end)).select(*GROWTH_COLUMNS)


def _stored_growth(spark: SparkSession, growth_path: str) -> DataFrame:
    """All stored growth rows, with the partition column."""
    return read_table(spark, f"{growth_path.rstrip('/')}/rows", GROWTH_DDL)


def _between(start, end) -> Column:
    until = F.col("snapshot_date") <= F.lit(to_date_param(end))
    return until if start is None else until & (F.col("snapshot_date") >= F.lit(to_date_param(start)))


def _tail_day(spark: SparkSession, growth_path: str) -> _dt.date | None:
    """The last day the stored growth covers: that of its newest tail."""
    done = _glob(spark, f"{growth_path.rstrip('/')}/tail/through=*")
    return max((_dt.date.fromisoformat(p.rstrip("/")[-10:]) for p in done), default=None)


def maintain_growth(
    spark: SparkSession, fact_path: str, growth_path: str, start, end, layout: str = "date",
    on_change: Callable[[DataFrame, DataFrame], None] | None = None,
) -> str:
    """SURVEY 7.5: bring the materialized growth up to date after fact days ``[start, end]`` were loaded.

    ``<growth>/rows`` has a folder per day (``layout="month"``: per month, for tables of many
    years with few rows a day), ``<growth>/tail`` the last snapshots of every game, written last and
    named by the last day taken in. Folders are only ever replaced whole, by partition overwrite, so a
    run that failed is run again with the same range.

    * Days after that last one: the lag window runs over the tail and the new days only. Days
      skipped in between are taken in, whatever the range asked for (``"advanced"``).
    * Days up to it that changed or went: the games in them, now or before, are recomputed for
      those days and their next snapshots within the longest lag, and only the folders touched are written
      (``"repaired"``). Rows of other games are not read from the fact past the semi-join.
    * No growth yet: the whole history up to ``end`` (``"rebuilt"``).

    ``on_change(gone, come)`` is called with the growth rows that go and those that come, before
    anything is overwritten (``maintain_segments`` makes views of them).
    """
    root, folder = growth_path.rstrip("/"), _growth_folder(layout)
    start, end = to_date_param(start), to_date_param(end)
    through = _tail_day(spark, root)
    until = end if through is None else max(end, through)
    fact = read_fact(spark, fact_path).select(*TAIL_COLUMNS).where(F.col("snapshot_date") <= F.lit(until))
    if through is None:
        _replace_growth(spark, root, folder, game_growth(fact), None, set(), on_change)
        _write_tail(spark, root, next_tail(fact), until)
        return "rebuilt"
    old_tail = spark.read.schema(TAIL_DDL).parquet(f"{root}/tail/through={through.isoformat()}")
    before = _stored_growth(spark, root).select(*GROWTH_COLUMNS)
    new = F.col("snapshot_date") > F.lit(through)
    # At most one folder per day, also those a failed run has left after the last day.
    touched = lambda days: {r.p for r in before.where(days).select(folder[1].alias("p")).distinct().collect()}
    if start > through:
        batch = read_fact(spark, fact_path, through + _dt.timedelta(days=1), end).select(*TAIL_COLUMNS)
        _replace_growth(spark, root, folder, batch_growth(old_tail, batch, through), new, touched(new), on_change)
        _write_tail(spark, root, next_tail(old_tail.unionByName(batch)), until)
        return "advanced"
    changed = F.col("snapshot_date").between(F.lit(start), F.lit(end)) | new
    games = changed_games(fact, before, changed)
    keys = scratch_path(spark, "growth_games")
    games.write.parquet(keys)  # read by every branch below
    games = spark.read.schema("appid bigint").parquet(keys)
    history = fact.join(games, "appid", "left_semi")
    _replace_growth(spark, root, folder, changed_growth(history, before, changed), changed, touched(changed), on_change)
    others = old_tail.join(games, "appid", "left_anti")
    _write_tail(spark, root, next_tail(history.unionByName(others.select(*TAIL_COLUMNS))), until)
    return "repaired"


def _replace_growth(
    spark, root: str, folder: tuple[str, Column], rows: DataFrame, changed: Column | None, touched: set, on_change=None
) -> None:
    """Overwrite the folders of ``rows`` and those ``touched``, keeping their other stored rows: those in no
    changed day whose game and day are not among ``rows``. A folder left without rows is removed."""
    name, value = folder
    path = f"{root}/rows"
    if changed is None and on_change:
        on_change(spark.createDataFrame([], GROWTH_DDL), rows.select(*GROWTH_COLUMNS))
    if changed is not None:
        staged = scratch_path(spark, "growth_rows")
        rows.write.parquet(staged)  # what is overwritten must not be read meanwhile
        rows = spark.read.schema(GROWTH_DDL).parquet(staged)
        touched = touched | {r.p for r in rows.select(value.alias("p")).distinct().collect()}
        if not touched:
            return
        stored = _stored_growth(spark, root).where(F.col(name).isin(*touched)).select(*GROWTH_COLUMNS)
        days = rows.select("appid", "snapshot_date").distinct()
        kept = stored.where(~changed).join(days, ["appid", "snapshot_date"], "left_anti")
        if on_change:
            again = stored.where(~changed).join(days, ["appid", "snapshot_date"], "left_semi")
            gone = stored.where(changed).unionByName(again.select(*GROWTH_COLUMNS))
            gone = gone.where(F.col("snapshot_date") <= F.lit(_tail_day(spark, root)))  # not what a failed run has left
            on_change(gone.exceptAll(rows.select(*GROWTH_COLUMNS)), rows.select(*GROWTH_COLUMNS).exceptAll(gone))
        whole = scratch_path(spark, "growth_merged")
        rows.unionByName(kept.select(*GROWTH_COLUMNS)).write.parquet(whole)
        rows = spark.read.schema(GROWTH_DDL).parquet(whole)
    (
        rows.select(*GROWTH_COLUMNS, value.alias(name))
        .hint("rebalance", name)
        .sortWithinPartitions(name, "snapshot_date", "appid")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if changed is None else "dynamic")
        .option("compression", "snappy")
        .partitionBy(name)
        .parquet(path)
    )
    held = {r.p for r in rows.select(value.alias("p")).distinct().collect()} if touched else set()
    for gone in touched - held:
        _delete_path(spark, f"{path}/{name}={gone}")


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The stored sums per (date, segment)."""
    return read_table(spark, path, STATE_DDL).select(*[c.split()[0] for c in STATE_DDL.split(", ")])


def maintain_segments(spark: SparkSession, path: str, deltas: DataFrame, layout: str = "date") -> None:
    """Add signed deltas (``operators.segment_state``) to the sums stored under ``path``.

    Only the folders of dates that change are read and overwritten, each whole. Adding is not
    repeatable: a run that failed here is made up for by an empty path and the deltas of all rows.
    """
    name, value = _growth_folder(layout)
    staged, merged = scratch_path(spark, "segment_deltas"), scratch_path(spark, "segment_sums")
    deltas.write.parquet(staged)
    deltas = spark.read.schema(STATE_DDL).parquet(staged)
    touched = {r.p for r in deltas.select(value.alias("p")).distinct().collect()}  # one per day at most
    if not touched:
        return
    state = read_table(spark, path, STATE_DDL)
    state = state.where(F.col(name).isin(*touched)) if name in state.columns else state
    added(state, deltas).write.parquet(merged)
    sums = spark.read.schema(STATE_DDL).parquet(merged)
    (
        sums.withColumn(name, value)
        .hint("rebalance", name)
        .sortWithinPartitions(name, "snapshot_date", "segment")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(name)
        .parquet(path)
    )
    for gone in touched - {r.p for r in sums.select(value.alias("p")).distinct().collect()}:
        _delete_path(spark, f"{path.rstrip('/')}/{name}={gone}")


def _write_tail(spark, root: str, tail: DataFrame, through: _dt.date) -> None:
    """The tail up to ``through``; older ones go once it is there. It may be made from the one it replaces."""
    staged = scratch_path(spark, "growth_tail")
    tail.write.parquet(staged)
    folder = f"{root}/tail/through={through.isoformat()}"
    spark.read.schema(TAIL_DDL).parquet(staged).write.mode("overwrite").parquet(folder)
    for old in _glob(spark, f"{root}/tail/through=*"):
        if not old.endswith(through.isoformat()):
            _delete_path(spark, old)
