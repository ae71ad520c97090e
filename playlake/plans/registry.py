"""The query table: one callable per SURVEY 7.4 key, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables whole; the ones that exercise a writer write
into a fresh folder under the cluster's shared checkpoint folder and read it back.
``ORACLE_SQL`` holds the DuckDB statement each result is compared with.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.functions.casts import INT16, UINT8, UINT32, checked_cast
from playlake.functions.parse import (
    clean_age, list_field, minor_to_major, parse_fetched_at, parse_release_date, partition_path,
)
from playlake.operators.gold import build_dim, build_fact, latest_dim
from playlake.operators.growth import game_growth, genre_growth, publisher_growth
from playlake.operators.id_bitmaps import bitmap_ids, id_bitmaps, merged_bitmaps, not_in_bitmaps
from playlake.operators.segment_state import dim_deltas, genre_view, growth_deltas
from playlake.operators.silver import (
    bronze_to_silver, category_bridge, company_bridge, dedup_snapshots, genre_bridge, silver_main,
)
from playlake.operators.targets import daily_targets, full_load_targets
from playlake.plans import bindings as B
from playlake.plans.medallion import (
    gold_views, load_gold, load_silver, maintain_growth, maintain_segments, merge_silver, read_growth, read_segments, run_range,
)
from playlake.schemas import FACT_DDL
from playlake.session import scratch_path
from playlake.sources.bronze import (
    day_path, file_counts, known_ids, read_active_ids, read_applist, read_bronze,
    compact_bronze, land_lines, read_bronze_columns, read_bronze_day, write_applist, write_bronze, write_bronze_lines,
)
from playlake.sources.by_game import BUCKETS, refresh_by_game
from playlake.sources.landing import (
    attempt_outcomes, fetch_outcomes, numbered_pages, reconcile_targets, target_counts, unwrap_envelopes, unwrap_pages,
)
from playlake.sources.lake import (
    DIM_TABLE, FACT_TABLE, GOLD_TABLES, SILVER_TABLES, append_dim_versions, compact_dim_log, ensure_tables, read_dim_log, read_fact,
    read_silver, read_table, replace_fact_date, table_contract, table_path, write_fact,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# Fixed job parameters of the bindings (dates inside the driver's event month).
TARGET_DAY = "2024-01-15"
REPLACE_DAY = "2024-01-10"
BACKFILL_START, BACKFILL_END = "2023-12-30", "2024-01-31"
APPEND_SPLIT_DAY = "1998-01-01"
DIM_LOAD_TIME = _dt.datetime(2024, 2, 1)


def query(name: str, oracle: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn
    return register


def _t(spark, sf_dir, name):
    return B.table(spark, sf_dir, name)


def _event_days(spark, sf_dir):
    """First and last event day (two scalars; the data itself stays distributed)."""
    row = _t(spark, sf_dir, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return row[0], row[1]


def _land_raw(spark, sf_dir, rows_per_file=1000) -> str:
    """Write RAW (events as nested bronze records) as gzip JSON day folders."""
    root = scratch_path(spark, "bronze")
    write_bronze(B.events_as_bronze(_t(spark, sf_dir, "events")), root, rows_per_file=rows_per_file)
    return root


# ---------------------------------------------------------------------------- SQL pieces
FACT_CTE = """
fact AS (
  SELECT l_partkey AS appid, CAST(l_shipdate AS DATE) AS snapshot_date,
         CAST(sum(l_quantity) AS BIGINT) AS recommendations_total
  FROM lineitem GROUP BY 1, 2
), growth AS (
  SELECT snapshot_date, appid, recommendations_total,
         recommendations_total - lag(recommendations_total, 1, 0) OVER w AS rec_growth_1d,
         recommendations_total - lag(recommendations_total, 7, 0) OVER w AS rec_growth_7d,
         recommendations_total - lag(recommendations_total, 30, 0) OVER w AS rec_growth_30d
  FROM fact WINDOW w AS (PARTITION BY appid ORDER BY snapshot_date)
)"""

RAW_SILVER_CTE = """
raw AS (
  SELECT user_id AS appid, CAST(ts AS DATE) AS snapshot_date, ts AS fetched_at, event_type,
         value, props, event_id
  FROM events WHERE event_type <> 'error'
), dedup AS (
  SELECT * FROM raw
  QUALIFY row_number() OVER (PARTITION BY appid, snapshot_date ORDER BY fetched_at DESC NULLS FIRST) = 1
), silver AS (
  SELECT appid, snapshot_date, fetched_at, event_type AS type,
         'app-' || CAST(appid AS VARCHAR) AS name,
         snapshot_date AS release_date, value >= 250 AS coming_soon,
         TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) AS required_age,
         value < 5 AS is_free,
         CAST(round(value * 100) AS BIGINT) AS price_minor,
         CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 100.0 AS price,
         'EUR' AS currency,
         CAST(floor(value / 5) AS BIGINT) AS discount_percent,
         CASE WHEN event_type = 'view' THEN 0 ELSE event_id END AS recommendations_total,
         CASE WHEN event_type = 'click' THEN NULL ELSE CAST(floor(value) AS BIGINT) END AS metacritic_score,
         CAST(floor(value / 10) AS BIGINT) AS achievements_total
  FROM dedup
)"""

SILVER_SELECT = """
SELECT appid, snapshot_date, fetched_at, type, name, release_date, coming_soon, required_age,
       is_free, price_minor, price, currency, discount_percent, recommendations_total,
       metacritic_score, achievements_total
FROM silver"""

BRONZE_ROWS_SQL = """
SELECT user_id AS appid, event_type <> 'error' AS success,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS fetched_at, event_type AS type,
       CAST(ts AS DATE) AS snapshot_date
FROM events"""

LINEITEM_FACT_SQL = """
SELECT CAST(l_shipdate AS DATE) AS snapshot_date, l_partkey AS appid,
       l_extendedprice AS price, l_extendedprice * 1.0 AS price_usd,
       CASE WHEN l_returnflag <> 'R' THEN 'EUR' ELSE 'USD' END AS currency,
       CAST(round(l_discount * 100) AS SMALLINT) AS discount_percent,
       CAST(l_quantity AS BIGINT) AS recommendations_total,
       CAST(CASE WHEN l_linestatus <> 'O' THEN l_linenumber ELSE -1 END AS SMALLINT) AS metacritic_score,
       CAST(CASE WHEN l_returnflag <> 'A' THEN l_linenumber * 10 ELSE 0 END AS SMALLINT) AS achievements_total,
       CAST(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END AS SMALLINT) AS is_free,
       date_trunc('second', l_shipdate + to_microseconds(l_linenumber * 1250000)) AS fetched_at
FROM lineitem"""


def _bronze_rows(df: DataFrame) -> DataFrame:
    return df.select("appid", "success", "fetched_at", F.col("data.type").alias("type"), "snapshot_date")


# ---------------------------------------------------------------------------- growth views
def _fact(spark, sf_dir):
    return B.fact_from_lineitem(_t(spark, sf_dir, "lineitem"))


@query("game_growth", f"WITH {FACT_CTE} SELECT * FROM growth")
def q_game_growth(spark, sf_dir):
    return game_growth(_fact(spark, sf_dir))


@query("game_growth_incremental", f"WITH {FACT_CTE} SELECT * FROM growth")
def q_game_growth_incremental(spark, sf_dir):
    """D5 in the incremental mode of SURVEY 7.5, over a fact that holds its history already:
    the first step asks for a middle range (and takes in all days before it), the next skips
    days that the one after it must not lose, and only tails are carried between them."""
    base = scratch_path(spark, "growth_incr")
    fact = _fact(spark, sf_dir)
    fact_path = f"{base}/fact"
    write_fact(B.whole_fact_rows(fact), fact_path, mode="append", layout="month")
    first, last = fact.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    span = (last - first).days
    at = lambda part: first + _dt.timedelta(days=int(span * part))
    for lo, hi in ((at(0.3), at(0.5)), (at(0.6), at(0.7)), (at(0.95), last)):
        maintain_growth(spark, fact_path, f"{base}/growth", lo, hi, layout="month")
    return read_growth(spark, f"{base}/growth")


@query("game_growth_late_days", f"WITH {FACT_CTE} SELECT * FROM growth")
def q_game_growth_late_days(spark, sf_dir):
    """D5/W1-W3 with days that come late and days that change: the growth is built over a fact that
    lacks a week of every game, holds a day too many for some games and wrong totals on another day;
    then the fact gets its true rows and only what those days reach is recomputed."""
    base = scratch_path(spark, "growth_late")
    fact = _fact(spark, sf_dir).where("snapshot_date is not null")
    first, last = fact.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    at = lambda part: first + _dt.timedelta(days=int((last - first).days * part))
    week, day = (at(0.4), at(0.4) + _dt.timedelta(days=6)), at(0.7)
    of = F.col("snapshot_date")
    wrong = F.col("recommendations_total") + F.when(of == F.lit(day), 5).otherwise(0)
    extra = fact.where("appid % 3 = 0").groupBy("appid").agg(F.lit(week[0]).alias("snapshot_date"), F.lit(1).cast("bigint").alias("recommendations_total"))
    early = fact.where(~of.between(*map(F.lit, week))).withColumn("recommendations_total", wrong).unionByName(extra.select(fact.columns))
    write_fact(B.whole_fact_rows(early), f"{base}/before", mode="append", layout="month")
    write_fact(B.whole_fact_rows(fact), f"{base}/fact", mode="append", layout="month")
    maintain_growth(spark, f"{base}/before", f"{base}/growth", first, last, layout="month")
    maintain_growth(spark, f"{base}/fact", f"{base}/growth", *week, layout="month")
    maintain_growth(spark, f"{base}/fact", f"{base}/growth", day, day, layout="month")
    return read_growth(spark, f"{base}/growth")


@query("genre_growth", f"""
WITH {FACT_CTE}, dim AS (
  SELECT p_partkey AS appid, unnest(string_split(p_name, ' ')) AS genre FROM part
)
SELECT g.snapshot_date, d.genre,
       CAST(sum(g.rec_growth_1d) AS BIGINT) AS genre_growth_1d,
       CAST(sum(g.rec_growth_7d) AS BIGINT) AS genre_growth_7d,
       avg(g.recommendations_total) AS avg_recommendations
FROM growth g JOIN dim d ON g.appid = d.appid
GROUP BY g.snapshot_date, d.genre""")
def q_genre_growth(spark, sf_dir):
    return genre_growth(game_growth(_fact(spark, sf_dir)), B.dim_from_part(_t(spark, sf_dir, "part")))


@query("publisher_growth", f"""
WITH {FACT_CTE}
SELECT g.snapshot_date, p.p_brand AS publisher,
       CAST(sum(g.rec_growth_1d) AS BIGINT) AS pub_growth_1d,
       CAST(sum(g.rec_growth_7d) AS BIGINT) AS pub_growth_7d
FROM growth g JOIN part p ON g.appid = p.p_partkey
GROUP BY g.snapshot_date, p.p_brand""")
def q_publisher_growth(spark, sf_dir):
    return publisher_growth(game_growth(_fact(spark, sf_dir)), B.dim_from_part(_t(spark, sf_dir, "part")))


@query("genre_growth_maintained", f"""
WITH {FACT_CTE}, dim AS (
  SELECT p_partkey AS appid, unnest(string_split(p_name, ' ')) AS genre FROM part
)
SELECT g.snapshot_date, d.genre,
       CAST(sum(g.rec_growth_1d) AS BIGINT) AS genre_growth_1d,
       CAST(sum(g.rec_growth_7d) AS BIGINT) AS genre_growth_7d,
       avg(g.recommendations_total) AS avg_recommendations
FROM growth g JOIN dim d ON g.appid = d.appid
GROUP BY g.snapshot_date, d.genre""")
def q_genre_growth_maintained(spark, sf_dir):
    """D6/A6-A8 by signed deltas: genre sums are built over a fact that lacks a week and a dim
    whose games have other lists; then the dim changes, then the week comes late, and each time only what
    goes and what comes is added to the stored sums."""
    base = scratch_path(spark, "segments")
    fact = _fact(spark, sf_dir).where("snapshot_date is not null")
    first, last = fact.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    week = first + _dt.timedelta(days=int((last - first).days * 0.4))
    week = week, week + _dt.timedelta(days=6)
    dim = B.dim_from_part(_t(spark, sf_dir, "part")).select("appid", "genres")
    lists = F.when(F.col("appid") % 5 == 0, F.slice("genres", 1, 1)).when(F.col("appid") % 7 == 0, F.array(F.lit("other")))
    early_dim = dim.select("appid", lists.otherwise(F.col("genres")).alias("genres")).where("appid % 11 <> 0")
    early = fact.where(~F.col("snapshot_date").between(*map(F.lit, week)))
    write_fact(B.whole_fact_rows(early), f"{base}/before", mode="append", layout="month")
    write_fact(B.whole_fact_rows(fact), f"{base}/fact", mode="append", layout="month")
    growth, sums = f"{base}/growth", f"{base}/genres"
    keep = lambda of: lambda gone, come: maintain_segments(
        spark, sums, growth_deltas(gone, come, of, "genres"), layout="month")
    maintain_growth(spark, f"{base}/before", growth, first, last, layout="month", on_change=keep(early_dim))
    maintain_segments(spark, sums, dim_deltas(read_growth(spark, growth), early_dim, dim, "genres"), layout="month")
    maintain_growth(spark, f"{base}/fact", growth, *week, layout="month", on_change=keep(dim))
    return genre_view(read_segments(spark, sums))


# ---------------------------------------------------------------------------- silver
@query("silver_main", f"WITH {RAW_SILVER_CTE} {SILVER_SELECT}")
def q_silver_main(spark, sf_dir):
    """RAW landed as nested gzip JSON, read with the bronze schema, cleaned and deduplicated."""
    root = _land_raw(spark, sf_dir)
    return silver_main(bronze_to_silver(read_bronze(spark, root)))


@query("silver_dedup", """
SELECT user_id AS appid, CAST(ts AS DATE) AS snapshot_date, ts AS fetched_at, event_id
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC NULLS FIRST) = 1""")
def q_silver_dedup(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select(
        F.col("user_id").alias("appid"), F.to_date("ts").alias("snapshot_date"),
        F.col("ts").alias("fetched_at"), "event_id",
    )
    return dedup_snapshots(ev)


def _day_records(spark, sf_dir):
    return B.part_day_records(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"))


def _line_records(spark, sf_dir):
    return B.line_records(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"))


@query("bridge_genre", """
WITH k AS (SELECT DISTINCT l_partkey AS appid, CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem)
SELECT k.snapshot_date, k.appid, unnest(string_split(p.p_name, ' ')) AS genre
FROM k JOIN part p ON p.p_partkey = k.appid""")
def q_bridge_genre(spark, sf_dir):
    return genre_bridge(_day_records(spark, sf_dir))


@query("bridge_category", """
WITH k AS (SELECT DISTINCT l_partkey AS appid, CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem)
SELECT k.snapshot_date, k.appid, unnest(string_split(p.p_type, ' ')) AS category
FROM k JOIN part p ON p.p_partkey = k.appid""")
def q_bridge_category(spark, sf_dir):
    return category_bridge(_day_records(spark, sf_dir))


@query("bridge_company", """
SELECT CAST(l_shipdate AS DATE) AS snapshot_date, l_partkey AS appid, l_returnflag AS company,
       'developer' AS role
FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)
UNION
SELECT CAST(l_shipdate AS DATE), l_partkey, l_linestatus, 'publisher'
FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)""")
def q_bridge_company(spark, sf_dir):
    return company_bridge(_line_records(spark, sf_dir))


# ---------------------------------------------------------------------------- gold
@query("fact_build", LINEITEM_FACT_SQL)
def q_fact_build(spark, sf_dir):
    return build_fact(B.silver_main_from_lineitem(_t(spark, sf_dir, "lineitem")))


DIM_SQL = """
WITH li AS (
  SELECT l_partkey AS appid, CAST(l_shipdate AS DATE) AS snapshot_date, l_returnflag, l_linestatus
  FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part)
), latest AS (
  SELECT appid, max(snapshot_date) AS snapshot_date FROM li GROUP BY appid
), lists AS (
  SELECT li.appid,
         list_sort(list(DISTINCT l_returnflag)) AS developers,
         list_sort(list(DISTINCT l_linestatus)) AS publishers
  FROM li JOIN latest USING (appid, snapshot_date) GROUP BY li.appid
)
SELECT latest.appid, p.p_name AS name, p.p_type AS type,
       CAST(latest.snapshot_date - p.p_size AS DATE) AS release_date,
       CAST(p.p_size AS SMALLINT) AS required_age,
       CAST(CASE WHEN p.p_size > 25 THEN 1 ELSE 0 END AS SMALLINT) AS coming_soon,
       list_sort(string_split(p.p_name, ' ')) AS genres, list_sort(string_split(p.p_type, ' ')) AS categories,
       lists.developers,
       lists.publishers, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM latest JOIN part p ON p.p_partkey = latest.appid JOIN lists ON lists.appid = latest.appid"""


@query("dim_build", DIM_SQL)
def q_dim_build(spark, sf_dir):
    """D4 on RECORDS: one dim version per part from its latest ship day, four sorted lists."""
    main, lines = _day_records(spark, sf_dir), _line_records(spark, sf_dir)
    return build_dim(
        main, genre_bridge(main), category_bridge(main), company_bridge(lines), updated_at=DIM_LOAD_TIME
    )


@query("dim_latest", """
SELECT user_id AS appid, arg_max('app-' || CAST(user_id AS VARCHAR), (ts, event_id)) AS name,
       arg_max(event_type, (ts, event_id)) AS type, max(ts) AS updated_at
FROM events GROUP BY user_id""")
def q_dim_latest(spark, sf_dir):
    """Events as a dim version log (version time = ts, load seq = event id); newest per user."""
    events = _t(spark, sf_dir, "events")
    log = _dim_versions(events, F.col("event_id").alias("load_seq"))
    return latest_dim(log).select("appid", "name", "type", "updated_at")


@query("fact_append", LINEITEM_FACT_SQL)
def q_fact_append(spark, sf_dir):
    """K6: the lineitem fact appended in two loads (split at a day), read back whole."""
    fact = build_fact(B.silver_main_from_lineitem(_t(spark, sf_dir, "lineitem")))
    path = scratch_path(spark, "fact_append")
    early = F.col("snapshot_date") < F.lit(APPEND_SPLIT_DAY).cast("date")
    write_fact(fact.where(early), path, mode="append", layout="month")
    write_fact(fact.where(~early | F.col("snapshot_date").isNull()), path, mode="append", layout="month")
    return read_fact(spark, path)


@query("fact_replace_date", f"""
SELECT CAST(ts AS DATE) AS snapshot_date, user_id AS appid, value AS price, value * 1.0 AS price_usd,
       'USD' AS currency, CAST(0 AS SMALLINT) AS discount_percent, event_id AS recommendations_total,
       CAST(-1 AS SMALLINT) AS metacritic_score, CAST(0 AS SMALLINT) AS achievements_total,
       CAST(0 AS SMALLINT) AS is_free, date_trunc('second', ts) AS fetched_at
FROM events
WHERE NOT (CAST(ts AS DATE) = DATE '{REPLACE_DAY}' AND event_type = 'error')""")
def q_fact_replace_date(spark, sf_dir):
    """K7: events loaded as facts, then one day replaced by its non-error rows."""
    sm = B.events_silver_main(_t(spark, sf_dir, "events"))
    path = scratch_path(spark, "fact_replace")
    write_fact(build_fact(sm), path, mode="replace_date")
    day = F.col("snapshot_date") == F.lit(REPLACE_DAY).cast("date")
    replace_fact_date(build_fact(sm.where(day & (F.col("event_type") != "error"))), path, REPLACE_DAY)
    return read_fact(spark, path)


@query("fact_replace_by_nothing", f"""
SELECT CAST(ts AS DATE) AS snapshot_date, user_id AS appid, value AS price, event_id AS recommendations_total
FROM events
WHERE CAST(ts AS DATE) <> DATE '{REPLACE_DAY}'""")
def q_fact_replace_by_nothing(spark, sf_dir):
    """Events loaded as facts, then one day replaced by no rows: the day is gone, no other is."""
    sm = B.events_silver_main(_t(spark, sf_dir, "events"))
    path = scratch_path(spark, "fact_replace_none")
    write_fact(build_fact(sm), path, mode="replace_date")
    replace_fact_date(build_fact(sm.where("value < 0 AND value > 0")), path, REPLACE_DAY)
    return read_fact(spark, path).select("snapshot_date", "appid", "price", "recommendations_total")


@query("fact_month_layout", """
SELECT CAST(strftime(CAST(l_shipdate AS DATE), '%Y%m') AS INTEGER) AS snapshot_month,
       count(*) AS n_rows, count(DISTINCT l_partkey) AS n_appids
FROM lineitem GROUP BY 1""")
def q_fact_month_layout(spark, sf_dir):
    """The lineitem fact written in month folders; rows and games per stored month."""
    path = scratch_path(spark, "fact_layout")
    fact = build_fact(B.silver_main_from_lineitem(_t(spark, sf_dir, "lineitem")))
    write_fact(fact, path, mode="append", layout="month")
    stored = read_table(spark, path, FACT_DDL + ", snapshot_month int")
    return stored.groupBy("snapshot_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("appid").alias("n_appids")
    )


@query("fact_clustered", f"""
WITH f AS ({LINEITEM_FACT_SQL})
SELECT f.*, (SELECT max(l_partkey) FROM lineitem) // 2 < appid AS upper FROM f""")
def q_fact_clustered(spark, sf_dir):
    """The lineitem fact in files that do not overlap in (day, appid); the halves of the
    catalogue are read through a filter each."""
    path = scratch_path(spark, "fact_clustered")
    lines = _t(spark, sf_dir, "lineitem")
    write_fact(build_fact(B.silver_main_from_lineitem(lines)), path, mode="append", layout="month", clustered=True)
    middle = lines.agg(F.max("l_partkey")).first()[0] // 2
    upper = F.col("appid") > middle
    half = lambda which, name: read_fact(spark, path).where(which).withColumn("upper", F.lit(name))
    return half(upper, True).unionByName(half(~upper, False))


# ---------------------------------------------------------------------------- planning
@query("daily_targets", f"""
SELECT DISTINCT user_id AS appid FROM events
WHERE user_id IS NOT NULL AND user_id NOT IN (
  SELECT user_id FROM events WHERE CAST(ts AS DATE) = DATE '{TARGET_DAY}' AND user_id IS NOT NULL)""")
def q_daily_targets(spark, sf_dir):
    """Users (as active ids) not in that day's landed bronze."""
    root = _land_raw(spark, sf_dir)
    active = read_active_ids(spark, f"{sf_dir.rstrip('/')}/events.parquet", column="user_id")
    fetched = read_bronze_day(spark, root, TARGET_DAY, schema="appid bigint")
    return daily_targets(active, fetched)


@query("full_load_targets", """
SELECT COALESCE(o_custkey, 0) AS appid FROM orders
WHERE COALESCE(o_custkey, 0) NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def q_full_load_targets(spark, sf_dir):
    """Order customers as an app-list snapshot, minus every id ever landed (duplicates kept)."""
    root = _land_raw(spark, sf_dir)
    applist_root = scratch_path(spark, "applist")
    apps = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("appid"))
    write_applist(apps, applist_root, TARGET_DAY)
    app_list = read_applist(spark, day_path(applist_root, TARGET_DAY))
    return full_load_targets(app_list, known_ids(spark, root))


@query("known_ids", "SELECT DISTINCT user_id AS appid FROM events WHERE user_id IS NOT NULL")
def q_known_ids(spark, sf_dir):
    """Distinct ids over every landed bronze day."""
    return known_ids(spark, _land_raw(spark, sf_dir))


@query("known_ids_bitmap", "SELECT DISTINCT user_id AS appid FROM events WHERE user_id IS NOT NULL")
def q_known_ids_bitmap(spark, sf_dir):
    """S2/A9 as bitmaps: the set of each half of the days, merged and read back as ids."""
    root = _land_raw(spark, sf_dir)
    day = lambda which: id_bitmaps(read_bronze(spark, root, schema="appid bigint").where(which))
    return bitmap_ids(merged_bitmaps(day("day % 2 = 0"), day("day % 2 = 1")))


@query("full_load_targets_bitmap", """
SELECT COALESCE(o_custkey, 0) AS appid FROM orders
WHERE COALESCE(o_custkey, 0) NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")
def q_full_load_targets_bitmap(spark, sf_dir):
    """J5/D9 as bitmaps: order customers whose bit is not set among the ids landed."""
    known = id_bitmaps(read_bronze(spark, _land_raw(spark, sf_dir), schema="appid bigint"))
    apps = _t(spark, sf_dir, "orders").select(F.coalesce(F.col("o_custkey").cast("bigint"), F.lit(0)).alias("appid"))
    return not_in_bitmaps(apps, known)


@query("active_ids", "SELECT CAST(c_custkey AS BIGINT) AS appid FROM customer WHERE c_custkey IS NOT NULL")
def q_active_ids(spark, sf_dir):
    return read_active_ids(spark, f"{sf_dir.rstrip('/')}/customer.parquet", column="c_custkey")


# ---------------------------------------------------------------------------- bronze scans and writes
@query("bronze_scan_day", BRONZE_ROWS_SQL)
def q_bronze_scan_day(spark, sf_dir):
    """Landed RAW read back day by day (partition-pruned range covering every event day)."""
    root = _land_raw(spark, sf_dir)
    first, last = _event_days(spark, sf_dir)
    return _bronze_rows(read_bronze(spark, root, first, last))


@query("bronze_scan_projected", """
SELECT user_id AS appid, CASE WHEN value < 100 THEN event_type END AS kind,
       CASE WHEN value >= 100 THEN value END AS amount, CAST(ts AS DATE) AS snapshot_date
FROM events""")
def q_bronze_scan_projected(spark, sf_dir):
    """S3/U4: two file sets with different columns in the same day folders, merged by name."""
    ev = _t(spark, sf_dir, "events")
    root = scratch_path(spark, "bronze_projected")
    base = [F.col("user_id").alias("appid"), B.iso_micros(F.col("ts")).alias("fetched_at"),
            F.to_date("ts").alias("snapshot_date")]
    low = ev.where(F.col("value") < 100).select(*base, F.col("event_type").alias("kind"))
    high = ev.where(~(F.col("value") < 100) | F.col("value").isNull()).select(*base, F.col("value").alias("amount"))
    write_bronze(low, root)
    write_bronze(high, root)
    return read_bronze_columns(
        spark, root, ["appid", "kind", "amount", "snapshot_date"],
        schema="appid bigint, fetched_at string, kind string, amount double",
    )


@query("bronze_scan_untyped", """
SELECT user_id AS appid, CAST(ts AS DATE) AS snapshot_date,
       CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'id-' || event_id END AS ref,
       CASE WHEN event_id % 2 = 0 THEN event_id / 2.0 ELSE user_id::DOUBLE END AS amount,
       CASE WHEN event_id % 2 = 0 THEN '{"n":' || event_id || '}' ELSE '[' || event_id || ',"x"]' END AS detail,
       CASE WHEN event_id % 2 = 0 THEN event_type <> 'error' END AS ok,
       CASE WHEN event_id % 2 = 1 THEN [user_id, event_id] END AS pair
FROM events""")
def q_bronze_scan_untyped(spark, sf_dir):
    """S3/U4/P10 without a schema: two file sets of the same day folders whose fields differ in
    name and type, read once and merged by name; where types conflict the stated rule decides."""
    ev = _t(spark, sf_dir, "events")
    c = F.col
    number, user, day = c("event_id").cast("string"), c("user_id").cast("string"), F.to_date("ts").alias("snapshot_date")
    half = (c("event_id") / 2).cast("decimal(20,1)").cast("string")
    even = F.concat(F.lit('{"appid":'), user, F.lit(',"ref":'), number, F.lit(',"amount":'), half, F.lit(',"detail":{"n":'), number,
                    F.lit('},"ok":'), F.when(c("event_type") == "error", "false").otherwise("true"), F.lit(',"none":null}'))
    odd = F.concat(F.lit('{"ref":"id-'), number, F.lit('","amount":'), user, F.lit(',"detail":['), number, F.lit(',"x"],"pair":['),
                   user, F.lit(","), number, F.lit('],"appid":'), user, F.lit("}"))
    root = scratch_path(spark, "bronze_untyped")
    land_lines(ev.where("event_id % 2 = 0").select(even.alias("value"), day), root)
    land_lines(ev.where("event_id % 2 = 1").select(odd.alias("value"), day), root)
    return read_bronze_columns(spark, root, ["appid", "snapshot_date", "ref", "amount", "detail", "ok", "pair"])


@query("missing_partition_empty", """
WITH b AS (SELECT min(CAST(ts AS DATE)) - 1 AS s, max(CAST(ts AS DATE)) + 1 AS e FROM events),
days AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS snapshot_date FROM b),
c AS (SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS n FROM events GROUP BY 1)
SELECT days.snapshot_date, CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows
FROM days LEFT JOIN c USING (snapshot_date)""")
def q_missing_partition_empty(spark, sf_dir):
    """Rows per requested day, one day before and after the data, absent days giving 0."""
    root = _land_raw(spark, sf_dir)
    first, last = _event_days(spark, sf_dir)
    s, e = first - _dt.timedelta(days=1), last + _dt.timedelta(days=1)
    days = spark.range(1).select(F.explode(F.sequence(F.lit(s), F.lit(e))).alias("snapshot_date"))
    counts = read_bronze(spark, root, s, e, schema="appid bigint").groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n")
    )
    return days.join(counts, "snapshot_date", "left").select(
        "snapshot_date", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n_rows")
    )


@query("partition_file_counts", """
SELECT CAST(ts AS DATE) AS snapshot_date, CAST(ceil(count(*) / 100.0) AS BIGINT) AS n_files
FROM events GROUP BY 1""")
def q_partition_file_counts(spark, sf_dir):
    """A10: files per day folder after writing at most 100 rows per file."""
    root = _land_raw(spark, sf_dir, rows_per_file=100)
    return file_counts(spark, root)


@query("partition_path", """
SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date,
       strftime(CAST(ts AS DATE), 'year=%Y/month=%m/day=%d') AS path
FROM events""")
def q_partition_path(spark, sf_dir):
    days = _t(spark, sf_dir, "events").select(F.to_date("ts").alias("snapshot_date")).distinct()
    return days.select("snapshot_date", partition_path("snapshot_date").alias("path"))


@query("silver_read_back", f"WITH {RAW_SILVER_CTE} {SILVER_SELECT}")
def q_silver_read_back(spark, sf_dir):
    """The silver load over the event days, main table read back."""
    root = _land_raw(spark, sf_dir)
    silver_root = scratch_path(spark, "silver")
    first, last = _event_days(spark, sf_dir)
    load_silver(spark, root, silver_root, first, last)
    return read_silver(spark, silver_root, "game_daily", first, last)


@query("silver_merged", f"WITH {RAW_SILVER_CTE} {SILVER_SELECT}")
def q_silver_merged(spark, sf_dir):
    """D1/W4 by merging: every third event lands late, in two goes; each is merged into the rows the
    dedup has kept of the others, and the main table read back."""
    base, events = scratch_path(spark, "silver_merged"), _t(spark, sf_dir, "events")
    first, last = _event_days(spark, sf_dir)
    parts = [events.where("event_id % 3 <> 0"), events.where("event_id % 6 = 0"), events.where("event_id % 6 = 3")]
    write_bronze(B.events_as_bronze(parts[0]), f"{base}/bronze")
    load_silver(spark, f"{base}/bronze", f"{base}/silver", first, last, keep_state=True)
    for n, part in enumerate(parts[1:]):
        write_bronze(B.events_as_bronze(part), f"{base}/late-{n}")
        merge_silver(spark, read_bronze(spark, f"{base}/late-{n}"), f"{base}/bronze", f"{base}/silver")
    return read_silver(spark, f"{base}/silver", "game_daily", first, last)


@query("bronze_batches", BRONZE_ROWS_SQL)
def q_bronze_batches(spark, sf_dir):
    """K3: RAW written in files of at most 1,000 rows, read back whole."""
    root = _land_raw(spark, sf_dir, rows_per_file=1000)
    return _bronze_rows(read_bronze(spark, root))


@query("bronze_compact", """
SELECT CAST(ts AS DATE) AS snapshot_date,
       CASE WHEN event_id % 50 = 0 THEN '{"appid":' || user_id || ',"succ'
            ELSE '{"appid":' || user_id || ',"success":' || CASE WHEN event_type = 'error' THEN 'false' ELSE 'true' END
                 || ',"batch":' || event_id || ',"data":{"name":"app-' || user_id || '","short_description":"'
                 || event_type || '","platforms":{"linux":true}}}' END AS line
FROM events""")
def q_bronze_compact(spark, sf_dir):
    """K5: 100-line files, fields beyond the silver contract and broken lines among them,
    compacted; every line as it is stored afterwards."""
    c = F.col
    user = c("user_id").cast("string")
    whole = F.concat(
        F.lit('{"appid":'), user, F.lit(',"success":'), F.when(c("event_type") == "error", "false").otherwise("true"),
        F.lit(',"batch":'), c("event_id").cast("string"), F.lit(',"data":{"name":"app-'), user,
        F.lit('","short_description":"'), c("event_type"), F.lit('","platforms":{"linux":true}}}'),
    )
    broken = F.concat(F.lit('{"appid":'), user, F.lit(',"succ'))
    lines = _t(spark, sf_dir, "events").select(
        F.when(c("event_id") % 50 == 0, broken).otherwise(whole).alias("value"), F.to_date("ts").alias("snapshot_date")
    )
    root = scratch_path(spark, "bronze_lines")
    land_lines(lines, root, rows_per_file=100)
    first, last = _event_days(spark, sf_dir)
    compact_bronze(spark, root, first, last)
    stored = spark.read.option("basePath", root).option("lineSep", "\n").text(root)
    return stored.select(F.make_date("year", "month", "day").alias("snapshot_date"), c("value").alias("line"))


@query("applist_flatten", "SELECT p_partkey AS appid, p_name AS name FROM part")
def q_applist_flatten(spark, sf_dir):
    """One snapshot in both stored shapes, even parts in nested documents, odd ones as flat rows."""
    path = day_path(scratch_path(spark, "applist_mixed"), TARGET_DAY)
    part, even = _t(spark, sf_dir, "part"), F.col("p_partkey") % 2 == 0
    B.part_applist_nested(part.where(even)).write.option("compression", "gzip").json(path)
    flat = part.where(~even).select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    flat.write.mode("append").option("compression", "gzip").json(path)
    return read_applist(spark, path).select("appid", "name")


@query("applist_snapshot", "SELECT p_partkey AS appid, p_name AS name FROM part")
def q_applist_snapshot(spark, sf_dir):
    """K4: parts as the day's flat app-list snapshot, read back."""
    root = scratch_path(spark, "applist_flat")
    flat = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("appid"), F.col("p_name").alias("name"))
    write_applist(flat, root, TARGET_DAY)
    return read_applist(spark, day_path(root, TARGET_DAY)).select("appid", "name")


# ---------------------------------------------------------------------------- landing
@query("envelope_unwrap", """
SELECT user_id AS appid, true AS success, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS fetched_at,
       event_type AS type, 'app-' || CAST(user_id AS VARCHAR) AS name, 'about ' || event_type AS short_description
FROM events WHERE event_type NOT IN ('error', 'signup')""")
def q_envelope_unwrap(spark, sf_dir):
    """L1: events as keyed detail responses; failures and mis-keyed responses give no row. The
    payload comes whole: ``short_description`` is no field of any silver table."""
    landed = B.events_as_envelopes(_t(spark, sf_dir, "events"), misaddressed_type="signup")
    fields = F.from_json("data", "type string, name string, short_description string").alias("d")
    return unwrap_envelopes(landed).select("appid", "success", "fetched_at", fields).select(
        "appid", "success", "fetched_at", "d.*")


@query("page_unwrap", """
SELECT CASE WHEN p_partkey * 3 <= (SELECT max(p_partkey) FROM part) THEN 1 ELSE 2 END AS snapshot,
       p_partkey AS appid, p_name AS name
FROM part""")
def q_page_unwrap(spark, sf_dir):
    """L2: parts as two catalogue snapshots of different length, pages of 100, each
    concatenated up to its own last page."""
    return unwrap_pages(B.part_pages(_t(spark, sf_dir, "part")), "snapshot").select("snapshot", "appid", "name")


@query("page_cursor_unwrap", """
WITH k AS (SELECT p_partkey + 1 AS id, p_name FROM part), t AS (SELECT max(id) AS top FROM k),
p AS (SELECT CASE WHEN id * 3 <= top THEN 1 ELSE 2 END AS snapshot, id, p_name, top FROM k, t)
SELECT snapshot, CAST(floor((id - CASE WHEN snapshot = 1 THEN 0 ELSE top // 3 END - 1) / 100) AS BIGINT) AS page_no,
       id AS appid, p_name AS name
FROM p""")
def q_page_cursor_unwrap(spark, sf_dir):
    """The same pages without numbers, shuffled and some landed twice: ordered by the cursor
    each was asked after and the cursor each ends at, then concatenated. Ids begin at 1, as cursor 0 asks
    for the first page."""
    pages = B.part_pages(_t(spark, sf_dir, "part").withColumn("p_partkey", F.col("p_partkey") + 1))
    last = F.get_json_object("body", "$.response.last_appid").cast("bigint")
    cursors = pages.select("snapshot", (F.col("page_no") + 1).alias("page_no"), last.alias("after"))
    landed = pages.join(cursors, ["snapshot", "page_no"], "left").drop("page_no")
    twice = landed.unionByName(landed.where("after % 300 = 0")).orderBy(F.xxhash64("body"))
    return unwrap_pages(numbered_pages(twice, "snapshot"), "snapshot").select("snapshot", "page_no", "appid", "name")


@query("fetch_outcomes", """
WITH a AS (
  SELECT CAST(ts AS DATE) AS snapshot_date,
         coalesce(event_type NOT IN ('error', 'signup') AND event_id % 7 <> 0, false) AS ok
  FROM events)
SELECT snapshot_date, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_err,
       count(*) AS n_total
FROM a GROUP BY 1""")
def q_fetch_outcomes(spark, sf_dir):
    """Ok / err / total fetch attempts per event day, read from the landed bodies:
    failures, missing ids and bodies cut short are errors."""
    landed = B.events_as_envelopes(_t(spark, sf_dir, "events"), misaddressed_type="signup", keep=("event_id",))
    body = F.col("body")
    cut = F.when(F.col("event_id") % 7 == 0, F.substring(body, F.lit(1), F.length(body) - 6)).otherwise(body)
    return fetch_outcomes(attempt_outcomes(landed.withColumn("body", cut)))


OUTCOMES_CTE = """
seen AS (
  SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date, user_id AS appid FROM events),
targets AS (
  SELECT * FROM seen WHERE appid % 11 <> 0
  UNION SELECT snapshot_date + 1, appid FROM seen WHERE appid % 11 <> 0),
tried AS (
  SELECT CAST(ts AS DATE) AS snapshot_date, user_id AS appid, count(*) AS n,
         bool_or(coalesce(event_type NOT IN ('error', 'signup') AND event_id % 3 = 0, false)) AS ok
  FROM events GROUP BY 1, 2),
outcomes AS (
  SELECT coalesce(p.snapshot_date, t.snapshot_date) AS snapshot_date, coalesce(p.appid, t.appid) AS appid,
         CASE WHEN p.appid IS NULL THEN 'unplanned' WHEN t.ok THEN 'ok' WHEN t.n > 0 THEN 'err'
              ELSE 'unanswered' END AS outcome,
         coalesce(t.n, 0) AS n_attempts
  FROM targets p FULL JOIN tried t ON p.snapshot_date = t.snapshot_date AND p.appid = t.appid)"""


def _reconciled(spark, sf_dir):
    """Events as attempts; a day's targets are the apps of that day and of the day before, so the
    latter may stay unanswered; every eleventh app is fetched without a plan, two bodies in three are cut short."""
    events = _t(spark, sf_dir, "events")
    landed = B.events_as_envelopes(events, misaddressed_type="signup", keep=("event_id",))
    body = F.col("body")
    whole = F.when(F.col("event_id") % 3 == 0, body).otherwise(F.substring(body, F.lit(1), F.length(body) - 6))
    attempts = attempt_outcomes(landed.withColumn("body", whole), keep=("requested_appid",))
    seen = events.select(F.to_date("ts").alias("snapshot_date"), F.col("user_id").alias("appid")).where("appid % 11 <> 0")
    targets = seen.unionByName(seen.withColumn("snapshot_date", F.date_add("snapshot_date", 1)))
    return reconcile_targets(targets, attempts)


@query("target_outcomes", f"WITH {OUTCOMES_CTE} SELECT * FROM outcomes")
def q_target_outcomes(spark, sf_dir):
    """L3: planned targets reconciled with landed attempts, retries reduced to one outcome."""
    return _reconciled(spark, sf_dir)


@query("target_counts", f"""
WITH {OUTCOMES_CTE}
SELECT snapshot_date, count(*) FILTER (outcome = 'ok') AS n_ok,
       count(*) FILTER (outcome IN ('err', 'unanswered')) AS n_err,
       count(*) FILTER (outcome <> 'unplanned') AS n_total,
       count(*) FILTER (outcome = 'unanswered') AS n_unanswered,
       count(*) FILTER (outcome = 'unplanned') AS n_unplanned,
       count(*) FILTER (n_attempts > 1 AND outcome <> 'unplanned') AS n_retried,
       count(*) FILTER (n_attempts > 1 AND outcome = 'ok') AS n_recovered
FROM outcomes GROUP BY 1""")
def q_target_counts(spark, sf_dir):
    """Ok / err / total per planned target and day."""
    return target_counts(_reconciled(spark, sf_dir))


# ---------------------------------------------------------------------------- column functions
@query("parse_release_date", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ts AS DATE) END AS release_date
FROM events""")
def q_parse_release_date(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    raw = (F.when(F.col("event_type") == "error", F.date_format("ts", "MMM d, yyyy"))
           .when(F.col("event_type") == "view", F.date_format("ts", "dd MMM, yyyy"))
           .otherwise(F.date_format("ts", "d MMM, yyyy")))
    return ev.select("event_id", parse_release_date(raw).alias("release_date"))


@query("parse_fetched_at", """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL
            WHEN event_type = 'click' THEN date_trunc('second', ts) ELSE ts END AS fetched_at
FROM events""")
def q_parse_fetched_at(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    raw = (F.when(F.col("event_type") == "error", F.lit("bad"))
           .when(F.col("event_type") == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
           .otherwise(B.iso_micros(F.col("ts"))))
    return ev.select("event_id", parse_fetched_at(raw).alias("fetched_at"))


@query("clean_required_age", """
WITH r AS (
  SELECT event_id, CASE WHEN event_type = 'view' THEN props || '.0'
                        WHEN event_type = 'click' THEN '"' || props || '"'
                        WHEN event_type = 'error' THEN '-' ELSE props END AS raw
  FROM events)
SELECT event_id, TRY_CAST(regexp_replace(raw, '[^0-9]', '', 'g') AS BIGINT) AS required_age FROM r""")
def q_clean_required_age(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    p = F.col("props")
    raw = (F.when(F.col("event_type") == "view", F.concat(p, F.lit(".0")))
           .when(F.col("event_type") == "click", F.concat(F.lit('"'), p, F.lit('"')))
           .when(F.col("event_type") == "error", F.lit("-"))
           .otherwise(p))
    return ev.select("event_id", clean_age(raw).alias("required_age"))


@query("price_minor_major", """
SELECT event_id, CAST(round(value * 100) AS BIGINT) AS price_minor,
       CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 100.0 AS price
FROM events""")
def q_price_minor_major(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    minor = F.round(F.col("value") * 100).cast("bigint")
    return ev.select("event_id", minor.alias("price_minor"), minor_to_major(minor).alias("price"))


@query("list_field_extract", "SELECT event_id, [event_type, NULL] AS genres FROM events")
def q_list_field_extract(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    text = F.to_json(B.event_genres())
    parsed = F.from_json(text, "array<struct<id:string, description:string>>")
    return ev.select("event_id", list_field(parsed).alias("genres"))


@query("cast_checked", """
SELECT p_partkey AS appid, CAST(p_size AS SMALLINT) AS required_age,
       CAST(floor(p_retailprice) AS SMALLINT) AS metacritic_score,
       CAST(p_size * 100 AS SMALLINT) AS achievements_total
FROM part""")
def q_cast_checked(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    return p.select(
        checked_cast(F.col("p_partkey"), "bigint", UINT32, "appid").alias("appid"),
        checked_cast(F.col("p_size"), "smallint", UINT8, "required_age").alias("required_age"),
        checked_cast(F.floor("p_retailprice"), "smallint", INT16, "metacritic_score").alias("metacritic_score"),
        checked_cast(F.col("p_size") * 100, "smallint", INT16, "achievements_total").alias("achievements_total"),
    )


SCHEMA_SQL = """
SELECT * FROM (VALUES
  ('game_daily', 'appid', 'bigint'), ('game_daily', 'snapshot_date', 'date'), ('game_daily', 'fetched_at', 'timestamp_ntz'),
  ('game_daily', 'type', 'string'), ('game_daily', 'name', 'string'), ('game_daily', 'release_date', 'date'),
  ('game_daily', 'coming_soon', 'boolean'), ('game_daily', 'required_age', 'bigint'), ('game_daily', 'is_free', 'boolean'),
  ('game_daily', 'price_minor', 'bigint'), ('game_daily', 'price', 'double'), ('game_daily', 'currency', 'string'),
  ('game_daily', 'discount_percent', 'bigint'), ('game_daily', 'recommendations_total', 'bigint'),
  ('game_daily', 'metacritic_score', 'bigint'), ('game_daily', 'achievements_total', 'bigint'),
  ('game_genre', 'snapshot_date', 'date'), ('game_genre', 'appid', 'bigint'), ('game_genre', 'genre', 'string'),
  ('game_category', 'snapshot_date', 'date'), ('game_category', 'appid', 'bigint'), ('game_category', 'category', 'string'),
  ('game_company', 'snapshot_date', 'date'), ('game_company', 'appid', 'bigint'), ('game_company', 'company', 'string'),
  ('game_company', 'role', 'string'),
  ('fact_game_daily', 'snapshot_month', 'int'), ('fact_game_daily', 'snapshot_date', 'date'),
  ('fact_game_daily', 'appid', 'bigint'), ('fact_game_daily', 'price', 'double'), ('fact_game_daily', 'price_usd', 'double'),
  ('fact_game_daily', 'currency', 'string'), ('fact_game_daily', 'discount_percent', 'smallint'),
  ('fact_game_daily', 'recommendations_total', 'bigint'), ('fact_game_daily', 'metacritic_score', 'smallint'),
  ('fact_game_daily', 'achievements_total', 'smallint'), ('fact_game_daily', 'is_free', 'smallint'),
  ('fact_game_daily', 'fetched_at', 'timestamp_ntz'),
  ('dim_game', 'appid', 'bigint'), ('dim_game', 'name', 'string'), ('dim_game', 'type', 'string'),
  ('dim_game', 'release_date', 'date'), ('dim_game', 'required_age', 'smallint'), ('dim_game', 'coming_soon', 'smallint'),
  ('dim_game', 'genres', 'array<string>'), ('dim_game', 'categories', 'array<string>'),
  ('dim_game', 'developers', 'array<string>'), ('dim_game', 'publishers', 'array<string>'),
  ('dim_game', 'updated_at', 'timestamp_ntz'), ('dim_game', 'load_seq', 'bigint')
) AS t("table", "column", "type")"""


@query("schema_contract", SCHEMA_SQL)
def q_schema_contract(spark, sf_dir):
    """K9: the lake built from RAW over the event days, then (table, column, type) per
    stored table as read from its files; an absent table would show as such."""
    root = _land_raw(spark, sf_dir)
    base = scratch_path(spark, "contract")
    first, last = _event_days(spark, sf_dir)
    ensure_tables(spark, f"{base}/silver", tuple(SILVER_TABLES))
    ensure_tables(spark, f"{base}/gold", GOLD_TABLES)
    run_range(spark, root, f"{base}/silver", f"{base}/gold", first, last, updated_at=DIM_LOAD_TIME, load_seq=1)
    silver = table_contract(spark, f"{base}/silver", tuple(SILVER_TABLES))
    return silver.unionByName(table_contract(spark, f"{base}/gold", GOLD_TABLES))


# ---------------------------------------------------------------------------- stored tables
def _stored_silver(spark, sf_dir, between=lambda root: None) -> str:
    """The four silver tables, loaded twice: a second landing replaces every third day after
    it has lost its genres, its companies or all its successes (by the day's number).
    ``between`` is called with the silver root between the loads."""
    root, silver_root = scratch_path(spark, "bronze_rerun"), scratch_path(spark, "silver_rerun")
    first, last = _event_days(spark, sf_dir)
    raw = B.events_as_bronze(_t(spark, sf_dir, "events"))
    write_bronze(raw, root)
    load_silver(spark, root, silver_root, first, last)
    between(silver_root)
    day = F.dayofmonth("snapshot_date") % 6
    none = F.lit(None)
    data = F.col("data")
    data = F.when(day == 0, data.withField("genres", none.cast(raw.schema["data"].dataType["genres"].dataType))).when(
        day == 3, data.withField("developers", none.cast("array<string>")).withField("publishers", none.cast("array<string>"))
    ).otherwise(data)
    changed = raw.withColumn("success", F.col("success") & (day != 5)).withColumn("data", data)
    again = scratch_path(spark, "bronze_rerun")
    write_bronze(changed.where(F.dayofmonth("snapshot_date") % 3 != 1), again)
    load_silver(spark, again, silver_root, first, last)
    return silver_root


RERUN_CTE = f"""
{RAW_SILVER_CTE}, stored AS (
  SELECT *, day(snapshot_date) % 6 AS d FROM silver WHERE day(snapshot_date) % 6 <> 5
)"""


@query("stored_game_daily", f"WITH {RERUN_CTE} {SILVER_SELECT.replace('FROM silver', 'FROM stored')}")
def q_stored_game_daily(spark, sf_dir):
    """The main table after a re-run in which some days lost all their successes."""
    return read_silver(spark, _stored_silver(spark, sf_dir), "game_daily")


@query("stored_game_genre", f"""
WITH {RERUN_CTE}
SELECT snapshot_date, appid, type AS genre FROM stored WHERE d <> 0""")
def q_stored_game_genre(spark, sf_dir):
    """The genre table after a re-run in which some days lost all their genres."""
    return read_silver(spark, _stored_silver(spark, sf_dir), "game_genre")


@query("stored_game_category", f"""
WITH {RERUN_CTE}
SELECT snapshot_date, appid, CASE WHEN value >= 100 THEN 'high' ELSE 'low' END AS category
FROM stored JOIN (SELECT appid, snapshot_date, value FROM dedup) USING (appid, snapshot_date)""")
def q_stored_game_category(spark, sf_dir):
    """The category table after the same re-run."""
    return read_silver(spark, _stored_silver(spark, sf_dir), "game_category")


@query("stored_game_company", f"""
WITH {RERUN_CTE}
SELECT snapshot_date, appid, 'studio-' || type AS company, 'developer' AS role FROM stored WHERE d <> 3
UNION ALL
SELECT snapshot_date, appid, 'studio-' || type, 'publisher' FROM stored WHERE d <> 3
UNION ALL
SELECT snapshot_date, appid, 'indie house', 'publisher' FROM stored WHERE d <> 3""")
def q_stored_game_company(spark, sf_dir):
    """The company table after a re-run in which some days lost all their companies."""
    return read_silver(spark, _stored_silver(spark, sf_dir), "game_company")


@query("stored_fact", f"""
WITH {RERUN_CTE}
SELECT snapshot_date, appid, price, price * 1.0 AS price_usd, currency,
       CAST(discount_percent AS SMALLINT) AS discount_percent, recommendations_total,
       CAST(coalesce(metacritic_score, -1) AS SMALLINT) AS metacritic_score,
       CAST(achievements_total AS SMALLINT) AS achievements_total,
       CAST(is_free AS SMALLINT) AS is_free, date_trunc('second', fetched_at) AS fetched_at
FROM stored""")
def q_stored_fact(spark, sf_dir):
    """Gold loaded, then silver re-run so that some days lose all their rows, then gold
    loaded again: the fact follows and those days are gone."""
    gold = scratch_path(spark, "gold_rerun")
    first, last = _event_days(spark, sf_dir)
    load = lambda silver, seq: load_gold(
        spark, silver, gold, first, last, updated_at=DIM_LOAD_TIME, load_seq=seq)
    silver = _stored_silver(spark, sf_dir, between=lambda root: load(root, 1))
    load(silver, 2)
    return read_fact(spark, table_path(gold, FACT_TABLE))


def _dim_versions(events: DataFrame, *more) -> DataFrame:
    """Events as dim versions: version time = ts."""
    empty = F.array().cast("array<string>")
    return events.select(
        F.col("user_id").alias("appid"),
        F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("name"),
        F.col("event_type").alias("type"),
        F.lit(None).cast("date").alias("release_date"),
        F.lit(0).cast("smallint").alias("required_age"),
        F.lit(0).cast("smallint").alias("coming_soon"),
        empty.alias("genres"), empty.alias("categories"), empty.alias("developers"), empty.alias("publishers"),
        F.col("ts").alias("updated_at"),
        *more,
    )


@query("dim_version_log", """
SELECT user_id AS appid, arg_max(event_type, (ts, event_id % 3)) AS type, max(ts) AS updated_at
FROM events GROUP BY user_id""")
def q_dim_version_log(spark, sf_dir):
    """K8/W6/D4 as stored: three loads appended, thinned out after the second, read back newest per game."""
    path = scratch_path(spark, "dim_log")
    events = _t(spark, sf_dir, "events")
    for seq in range(3):
        append_dim_versions(_dim_versions(events.where(F.col("event_id") % 3 == seq)), path, seq)
        if seq == 1:
            compact_dim_log(spark, path)
    return latest_dim(read_dim_log(spark, path)).select("appid", "type", "updated_at")


def _stored_gold(spark, sf_dir) -> str:
    root, base = _land_raw(spark, sf_dir), scratch_path(spark, "gold_views")
    first, last = _event_days(spark, sf_dir)
    run_range(spark, root, f"{base}/silver", f"{base}/gold", first, last, updated_at=DIM_LOAD_TIME, load_seq=1)
    return f"{base}/gold"


STORED_GROWTH_CTE = f"""
{RAW_SILVER_CTE}, growth AS (
  SELECT snapshot_date, appid, recommendations_total AS rec,
         recommendations_total - lag(recommendations_total, 1, 0) OVER w AS g1,
         recommendations_total - lag(recommendations_total, 7, 0) OVER w AS g7
  FROM silver WINDOW w AS (PARTITION BY appid ORDER BY snapshot_date)
), dim AS (
  SELECT appid, arg_max(type, snapshot_date) AS type FROM silver GROUP BY appid
)"""


@query("stored_dim", f"""
WITH {RAW_SILVER_CTE}
SELECT appid, arg_max(name, snapshot_date) AS name, arg_max(type, snapshot_date) AS type,
       [arg_max(type, snapshot_date)] AS genres, list_sort(['studio-' || arg_max(type, snapshot_date), 'indie house']) AS publishers
FROM silver GROUP BY appid""")
def q_stored_dim(spark, sf_dir):
    """The stored dim of a whole load, newest version per game."""
    dim = latest_dim(read_dim_log(spark, table_path(_stored_gold(spark, sf_dir), DIM_TABLE)))
    return dim.select("appid", "name", "type", "genres", "publishers")


@query("stored_genre_view", f"""
WITH {STORED_GROWTH_CTE}
SELECT g.snapshot_date, d.type AS genre, CAST(sum(g1) AS BIGINT) AS genre_growth_1d,
       CAST(sum(g7) AS BIGINT) AS genre_growth_7d, avg(rec) AS avg_recommendations
FROM growth g JOIN dim d USING (appid) GROUP BY 1, 2""")
def q_stored_genre_view(spark, sf_dir):
    """The genre view over stored gold."""
    return gold_views(spark, _stored_gold(spark, sf_dir))["view_genre_growth"]


@query("stored_genre_view_by_game", ORACLE_SQL["stored_genre_view"])
def q_stored_genre_view_by_game(spark, sf_dir):
    """The genre view over stored gold dealt by game: fact and dim in the same buckets of appid."""
    gold = _stored_gold(spark, sf_dir)
    refresh_by_game(spark, gold)
    return gold_views(spark, gold, buckets=BUCKETS)["view_genre_growth"]


@query("stored_publisher_view", f"""
WITH {STORED_GROWTH_CTE}, pubs AS (
  SELECT appid, 'studio-' || type AS publisher FROM dim UNION ALL SELECT appid, 'indie house' FROM dim)
SELECT g.snapshot_date, p.publisher, CAST(sum(g1) AS BIGINT) AS pub_growth_1d, CAST(sum(g7) AS BIGINT) AS pub_growth_7d
FROM growth g JOIN pubs p USING (appid) GROUP BY 1, 2""")
def q_stored_publisher_view(spark, sf_dir):
    """The publisher view over stored gold."""
    return gold_views(spark, _stored_gold(spark, sf_dir))["view_publisher_growth"]


# ---------------------------------------------------------------------------- composite runs
@query("date_range_backfill", f"""
WITH days AS (
  SELECT CAST(unnest(generate_series(DATE '{BACKFILL_START}', DATE '{BACKFILL_END}', INTERVAL 1 DAY)) AS DATE)
         AS snapshot_date),
s AS (SELECT CAST(ts AS DATE) AS snapshot_date, count(DISTINCT user_id) AS n
      FROM events WHERE event_type <> 'error' GROUP BY 1)
SELECT days.snapshot_date, CAST(coalesce(s.n, 0) AS BIGINT) AS silver_rows,
       CASE WHEN s.n IS NULL THEN 'skipped' ELSE 'loaded' END AS status
FROM days LEFT JOIN s USING (snapshot_date)""")
def q_date_range_backfill(spark, sf_dir):
    """Silver then gold over a range wider than the data; per-day report."""
    root = _land_raw(spark, sf_dir)
    base = scratch_path(spark, "lake")
    return run_range(spark, root, f"{base}/silver", f"{base}/gold", BACKFILL_START, BACKFILL_END,
                     updated_at=DIM_LOAD_TIME, load_seq=1)


@query("medallion_end_to_end", """
WITH s AS (
  SELECT user_id AS appid, CAST(ts AS DATE) AS snapshot_date,
         CASE WHEN event_type = 'view' THEN 0 ELSE event_id END AS rec
  FROM events WHERE event_type <> 'error'
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC) = 1)
SELECT snapshot_date, appid, rec AS recommendations_total,
       rec - lag(rec, 1, 0) OVER w AS rec_growth_1d,
       rec - lag(rec, 7, 0) OVER w AS rec_growth_7d,
       rec - lag(rec, 30, 0) OVER w AS rec_growth_30d
FROM s WINDOW w AS (PARTITION BY appid ORDER BY snapshot_date)""")
def q_medallion_end_to_end(spark, sf_dir):
    """Landed responses -> bronze -> silver -> gold -> game growth view."""
    events = _t(spark, sf_dir, "events")
    base = scratch_path(spark, "medallion")
    # landed responses (JSON lines) -> bronze day folders
    landed_path = f"{base}/landed"
    B.events_as_envelopes(events).write.option("compression", "gzip").json(landed_path)
    landed = spark.read.schema("requested_appid bigint, body string, fetched_at string").json(landed_path)
    bronze = unwrap_envelopes(landed).withColumn("snapshot_date", F.to_date(F.col("fetched_at").substr(1, 10)))
    write_bronze_lines(bronze, f"{base}/bronze")
    first, last = _event_days(spark, sf_dir)
    load_silver(spark, f"{base}/bronze", f"{base}/silver", first, last)
    load_gold(spark, f"{base}/silver", f"{base}/gold", first, last, updated_at=DIM_LOAD_TIME, load_seq=1)
    return gold_views(spark, f"{base}/gold")["view_game_growth"]
