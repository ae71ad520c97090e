"""Table contracts as DDL strings.

Bronze is always read with an explicit schema: inference would turn the whole
``data`` column into a string as soon as one record carries ``"data": []``, and
a sample can miss optional structs entirely.
"""

from __future__ import annotations

# Table and column names and types are the contract of the tables.
# -- bronze -------------------------------------------------------------------
BRONZE_DATA_DDL = (
    "type string, name string, "
    "release_date struct<date:string, coming_soon:boolean>, "
    "required_age string, is_free boolean, "
    "price_overview struct<final:bigint, currency:string, discount_percent:bigint>, "
    "recommendations struct<total:bigint>, metacritic struct<score:bigint>, "
    "achievements struct<total:bigint>, "
    "genres array<struct<id:string, description:string>>, "
    "categories array<struct<id:bigint, description:string>>, "
    "developers array<string>, publishers array<string>"
)
BRONZE_DDL = f"appid bigint, success boolean, fetched_at string, data struct<{BRONZE_DATA_DDL}>"
BRONZE_COLUMNS = ["appid", "success", "fetched_at", "data"]

# Landed detail envelope: {"<appid>": {"success": ..., "data": {...}}}. The payload stays the
# text it came as, so bronze keeps fields that no silver column reads.
ENVELOPE_DDL = "map<string, struct<success:boolean, data:string>>"
# The same without the payload, which the parser then skips.
OUTCOME_DDL = "map<string, struct<success:boolean>>"

# Landed catalogue page: {"response": {"apps": [...], "have_more_results": ..., "last_appid": ...}}
APP_DDL = "appid bigint, name string, last_modified bigint, price_change_number bigint"
APPLIST_DDL = f"applist struct<apps:array<struct<{APP_DDL}>>>, {APP_DDL}"
PAGE_DDL = (
    f"response struct<apps:array<struct<{APP_DDL}>>, have_more_results:boolean, last_appid:bigint>"
)

# -- silver -------------------------------------------------------------------
SILVER_MAIN_COLUMNS = [
    "appid", "snapshot_date", "fetched_at", "type", "name", "release_date", "coming_soon",
    "required_age", "is_free", "price_minor", "price", "currency", "discount_percent",
    "recommendations_total", "metacritic_score", "achievements_total",
]
SILVER_LIST_COLUMNS = ["genres", "categories", "developers", "publishers"]
SILVER_MAIN_DDL = (
    "appid bigint, snapshot_date date, fetched_at timestamp_ntz, type string, name string, "
    "release_date date, coming_soon boolean, required_age bigint, is_free boolean, "
    "price_minor bigint, price double, currency string, discount_percent bigint, "
    "recommendations_total bigint, metacritic_score bigint, achievements_total bigint"
)
# The rows the dedup has kept, lists and all: what late files are merged into.
SILVER_KEPT_DDL = SILVER_MAIN_DDL + "".join(f", {c} array<string>" for c in SILVER_LIST_COLUMNS)
GENRE_DDL = "snapshot_date date, appid bigint, genre string"
CATEGORY_DDL = "snapshot_date date, appid bigint, category string"
COMPANY_DDL = "snapshot_date date, appid bigint, company string, role string"

# -- gold ---------------------------------------------------------------------
FACT_COLUMNS = [
    "snapshot_date", "appid", "price", "price_usd", "currency", "discount_percent",
    "recommendations_total", "metacritic_score", "achievements_total", "is_free", "fetched_at",
]
FACT_DDL = (
    "snapshot_date date, appid bigint, price double, price_usd double, currency string, "
    "discount_percent smallint, recommendations_total bigint, metacritic_score smallint, "
    "achievements_total smallint, is_free smallint, fetched_at timestamp_ntz"
)
DIM_COLUMNS = [
    "appid", "name", "type", "release_date", "required_age", "coming_soon",
    "genres", "categories", "developers", "publishers", "updated_at",
]
DIM_DDL = (
    "appid bigint, name string, type string, release_date date, required_age smallint, "
    "coming_soon smallint, genres array<string>, categories array<string>, "
    "developers array<string>, publishers array<string>, updated_at timestamp_ntz"
)
# The dim is stored as an append-only version log; load_seq orders versions that share updated_at.
DIM_LOG_DDL = DIM_DDL + ", load_seq bigint"

GROWTH_COLUMNS = [
    "snapshot_date", "appid", "recommendations_total",
    "rec_growth_1d", "rec_growth_7d", "rec_growth_30d",
]

TABLE_DDL = {
    "game_daily": SILVER_MAIN_DDL,
    "game_genre": GENRE_DDL,
    "game_category": CATEGORY_DDL,
    "game_company": COMPANY_DDL,
    "fact_game_daily": FACT_DDL,
    "dim_game": DIM_LOG_DDL,
}
