"""Relational operators of the medallion model, each ``DataFrame -> DataFrame``."""

from playlake.operators.dedup import latest_per_key
from playlake.operators.gold import build_dim, build_fact, latest_dim
from playlake.operators.growth import game_growth, genre_growth, publisher_growth, segment_growth
from playlake.operators.silver import (
    category_bridge, clean_bronze, company_bridge, dedup_snapshots, genre_bridge, silver_main,
)
from playlake.operators.targets import daily_targets, full_load_targets

__all__ = [
    "latest_per_key", "build_dim", "build_fact", "latest_dim",
    "game_growth", "genre_growth", "publisher_growth", "segment_growth",
    "category_bridge", "clean_bronze", "company_bridge", "dedup_snapshots", "genre_bridge", "silver_main",
    "daily_targets", "full_load_targets",
]
