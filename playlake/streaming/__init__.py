"""Incremental runs over newly landed bronze files (the daily trigger, as a stream)."""

from playlake.streaming.incremental import drain_incremental_load, start_incremental_load

__all__ = ["drain_incremental_load", "start_incremental_load"]
