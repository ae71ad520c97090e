"""playlake: a Spark-native batch analytics engine for daily game-catalogue snapshots.

Layers (all plain DataFrame functions, planned by Catalyst):

* ``sources``   - landed responses, bronze JSON, silver/gold parquet tables (read and write)
* ``functions`` - column-level parsing, cleaning and checked casts
* ``operators`` - silver cleaning/dedup/bridges, gold fact/dim, growth views, planning, accounting
* ``plans``     - composite dataflows (bronze -> silver -> gold over a date range) and query bindings
* ``streaming`` - incremental bronze -> silver runs over newly landed files
"""

from playlake.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
