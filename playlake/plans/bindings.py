"""Stand-ins: the driver's tables bound to the game-catalogue model.

* FACT    = lineitem: game = part, snapshot = ship day, total = summed quantity.
* DIM     = part: genres = words of the name, publishers = [brand], type, age = size.
* RAW     = events: game = user, snapshot = event day, success = not an error; a real
            nested bronze record is built per event and written as gzip JSON.
* RECORDS = (part, ship day) main records with the part's attributes, genres (name
            words) and categories (type words), plus one record per line item carrying
            developers = [return flag] and publishers = [line status].

Every frame here is derived from the given tables, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.schemas import BRONZE_DATA_DDL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# -- FACT / DIM ---------------------------------------------------------------
def whole_fact_rows(totals: DataFrame) -> DataFrame:
    """(snapshot_date, appid, recommendations_total) filled up to whole fact rows."""
    return totals.select(
        "snapshot_date", "appid", F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("double").alias("price_usd"), F.lit("USD").alias("currency"),
        F.lit(0).cast("smallint").alias("discount_percent"), "recommendations_total",
        F.lit(-1).cast("smallint").alias("metacritic_score"), F.lit(0).cast("smallint").alias("achievements_total"),
        F.lit(0).cast("smallint").alias("is_free"), F.lit(None).cast("timestamp_ntz").alias("fetched_at"),
    )


def fact_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """(snapshot_date, appid, recommendations_total): one row per (part, ship day)."""
    return lineitem.groupBy(
        F.col("l_partkey").alias("appid"), F.to_date("l_shipdate").alias("snapshot_date")
    ).agg(F.sum("l_quantity").cast("bigint").alias("recommendations_total"))


def dim_from_part(part: DataFrame) -> DataFrame:
    """A dim with list columns, one row per part."""
    return part.select(
        F.col("p_partkey").alias("appid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.split(F.col("p_name"), " ").alias("genres"),
        F.array(F.col("p_brand")).alias("publishers"),
    )


# -- RECORDS ------------------------------------------------------------------
# Line items one task groups by part: what it holds at once stays the same, whatever the table's size.
LINES_PER_TASK = 125_000


def lines_by_part(lineitem: DataFrame) -> DataFrame:
    """Line items dealt by part, so that what follows groups and joins by part without another shuffle.

    There are as many partitions as the rows ask for: a fixed number would have every task's hash
    tables and sorts grow with the table.
    """
    tasks = max(lineitem.sparkSession.sparkContext.defaultParallelism, -(-lineitem.count() // LINES_PER_TASK))
    return lineitem.repartition(tasks, "l_partkey")


def part_day_records(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Silver-shaped main records, one per (part, ship day), with the part's attributes.

    The (part, day) keys come from a ``distinct``, a streamed aggregate that keeps one row of a
    group, however many line items share a part and day.
    """
    keys = lines_by_part(lineitem).select(
        F.col("l_partkey").alias("appid"), F.to_date("l_shipdate").alias("snapshot_date")
    ).distinct()
    attrs = part.select(
        F.col("p_partkey").alias("appid"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.col("p_size").alias("p_size"),
        F.split(F.col("p_name"), " ").alias("genres"),
        F.split(F.col("p_type"), " ").alias("categories"),
    )
    return keys.join(attrs, "appid", "inner").select(
        "appid",
        "snapshot_date",
        "name",
        "type",
        F.date_sub(F.col("snapshot_date"), F.col("p_size")).alias("release_date"),
        (F.col("p_size") > 25).alias("coming_soon"),
        F.col("p_size").cast("bigint").alias("required_age"),
        "genres",
        "categories",
    )


def line_records(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Records carrying company lists, one per line item of a known part.

    developers = [return flag], publishers = [line status]; the company bridge explodes
    them row by row and keeps the distinct set.
    """
    known = part.select(F.col("p_partkey").alias("appid"))
    return lines_by_part(lineitem).select(
        F.col("l_partkey").alias("appid"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.array("l_returnflag").alias("developers"),
        F.array("l_linestatus").alias("publishers"),
    ).join(known, "appid", "left_semi")


def silver_main_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Silver main rows (one per line item) for the fact loader."""
    li = F.col
    return lineitem.select(
        li("l_partkey").alias("appid"),
        F.to_date("l_shipdate").alias("snapshot_date"),
        F.expr("timestampadd(MICROSECOND, l_linenumber * 1250000, l_shipdate)").alias("fetched_at"),
        li("l_extendedprice").alias("price"),
        F.when(li("l_returnflag") != "R", F.lit("EUR")).alias("currency"),
        F.round(li("l_discount") * 100).cast("bigint").alias("discount_percent"),
        li("l_quantity").cast("bigint").alias("recommendations_total"),
        F.when(li("l_linestatus") != "O", li("l_linenumber").cast("bigint")).alias("metacritic_score"),
        F.when(li("l_returnflag") != "A", (li("l_linenumber") * 10).cast("bigint")).alias("achievements_total"),
        (li("l_tax") == 0).alias("is_free"),
    )


# -- RAW ----------------------------------------------------------------------
def iso_micros(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def event_genres() -> Column:
    """The event's genre list: its type, then an entry without a description."""
    return F.array(
        F.struct(F.lit("1").alias("id"), F.col("event_type").alias("description")),
        F.struct(F.lit("2").alias("id"), F.lit(None).cast("string").alias("description")),
    )


def event_payload(*extra: Column) -> Column:
    """The nested ``data`` record built from one event (bronze schema), ``extra`` fields first."""
    c = F.col
    value = c("value")
    data = F.struct(
        *extra,
        c("event_type").alias("type"),
        F.concat(F.lit("app-"), c("user_id").cast("string")).alias("name"),
        F.struct(
            F.date_format("ts", "d MMM, yyyy").alias("date"),
            (value >= 250).alias("coming_soon"),
        ).alias("release_date"),
        c("props").alias("required_age"),
        (value < 5).alias("is_free"),
        F.struct(
            F.round(value * 100).cast("bigint").alias("final"),
            F.lit("EUR").alias("currency"),
            F.floor(value / 5).cast("bigint").alias("discount_percent"),
        ).alias("price_overview"),
        F.struct(F.when(c("event_type") != "view", c("event_id")).alias("total")).alias("recommendations"),
        F.when(c("event_type") != "click", F.struct(F.floor(value).cast("bigint").alias("score"))).alias(
            "metacritic"
        ),
        F.struct(F.floor(value / 10).cast("bigint").alias("total")).alias("achievements"),
        event_genres().alias("genres"),
        F.array(
            F.struct(
                F.lit(1).cast("bigint").alias("id"),
                F.when(value >= 100, F.lit("high")).otherwise(F.lit("low")).alias("description"),
            )
        ).alias("categories"),
        F.array(F.concat(F.lit("studio-"), c("event_type"))).alias("developers"),
        F.array(F.concat(F.lit("studio-"), c("event_type")), F.lit("indie house")).alias("publishers"),
    )
    more = "".join(f"{name} string, " for name in ["short_description"][: len(extra)])
    return data.cast(f"struct<{more}{BRONZE_DATA_DDL}>")


def events_as_bronze(events: DataFrame) -> DataFrame:
    """Bronze rows (appid, success, fetched_at, data) + the day they belong to."""
    return events.select(
        F.col("user_id").alias("appid"),
        (F.col("event_type") != "error").alias("success"),
        iso_micros(F.col("ts")).alias("fetched_at"),
        event_payload().alias("data"),
        F.to_date("ts").alias("snapshot_date"),
    )


def events_as_envelopes(events: DataFrame, misaddressed_type: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landed detail responses: ``requested_appid, body, fetched_at`` and the ``keep`` columns.

    The payload has a field, ``short_description``, that no silver table knows.

    Unsuccessful events land as ``{"<id>": {"success": false}}``. Events of
    ``misaddressed_type`` land keyed by another id, so the requested id is absent.
    """
    c = F.col
    key = c("user_id").cast("string")
    if misaddressed_type is not None:
        key = F.when(c("event_type") == misaddressed_type, F.concat(key, F.lit("-other"))).otherwise(key)
    ok = c("event_type") != "error"
    about = F.concat(F.lit("about "), c("event_type"))
    entry = F.struct(ok.alias("success"), F.when(ok, event_payload(about)).alias("data"))
    return events.select(
        c("user_id").alias("requested_appid"),
        F.to_json(F.create_map(key, entry)).alias("body"),
        iso_micros(c("ts")).alias("fetched_at"),
        F.to_date("ts").alias("snapshot_date"),
        *keep,
    )


def events_silver_main(events: DataFrame) -> DataFrame:
    """A minimal silver main from events (one row per event) for fact-load tests."""
    c = F.col
    return events.select(
        c("user_id").alias("appid"),
        F.to_date("ts").alias("snapshot_date"),
        c("ts").alias("fetched_at"),
        c("value").alias("price"),
        F.lit(None).cast("string").alias("currency"),
        F.lit(None).cast("bigint").alias("discount_percent"),
        c("event_id").alias("recommendations_total"),
        F.lit(None).cast("bigint").alias("metacritic_score"),
        F.lit(None).cast("bigint").alias("achievements_total"),
        F.lit(None).cast("boolean").alias("is_free"),
        c("event_type"),
    )


def part_pages(part: DataFrame, page_size: int = 100) -> DataFrame:
    """Landed catalogue pages: ``snapshot, page_no, body``; pages of ``page_size`` ids by key range.

    The first third of the keys is one snapshot, the rest another, so they differ in length.
    """
    c = F.col
    top = part.agg(F.max("p_partkey")).first()[0] or 0  # one scalar
    snapshot = F.when(c("p_partkey") * 3 <= top, 1).otherwise(2)
    first = F.when(snapshot == 1, 0).otherwise(top // 3)
    apps = part.select(
        snapshot.alias("snapshot"),
        F.floor((c("p_partkey") - first - 1) / page_size).cast("bigint").alias("page_no"),
        F.struct(c("p_partkey").alias("appid"), c("p_name").alias("name")).alias("app"),
    )
    # p_partkey is unique, so a page (a key range of page_size) holds at most page_size apps.
    pages = apps.groupBy("snapshot", "page_no").agg(F.sort_array(F.collect_list("app")).alias("apps"))
    last = F.floor((F.when(c("snapshot") == 1, top // 3).otherwise(top - top // 3) - 1) / page_size)
    more = c("page_no") < last
    response = F.struct(
        c("apps"),
        more.alias("have_more_results"),
        F.when(more, F.element_at(c("apps"), -1)["appid"]).alias("last_appid"),
    )
    return pages.select("snapshot", "page_no", F.to_json(F.struct(response.alias("response"))).alias("body"))


def part_applist_nested(part: DataFrame, chunk: int = 1000) -> DataFrame:
    """The nested app-list shape ``{"applist": {"apps": [...]}}``, one document per id block."""
    c = F.col
    apps = part.select(
        F.floor(c("p_partkey") / chunk).alias("block"),
        F.struct(c("p_partkey").alias("appid"), c("p_name").alias("name")).alias("app"),
    )
    # Unique keys: a block (a key range of ``chunk``) holds at most ``chunk`` apps.
    return apps.groupBy("block").agg(F.sort_array(F.collect_list("app")).alias("apps")).select(
        F.struct(c("apps")).alias("applist")
    )
