"""Command line for the batch tasks: ``python -m playlake <task> ...``.

Each task is one call into the library (one or a few Spark jobs); scheduling is left
to whatever runs the command (cron, an orchestrator, spark-submit).

  silver    --bronze B --silver S --start D --end D          bronze days -> silver tables
  gold      --silver S --gold G --start D --end D [--append] silver days -> fact + dim versions
  backfill  --bronze B --silver S --gold G --start D --end D silver then gold, prints the day report
  compact   --bronze B --start D --end D [--rows-per-file N] rewrite day folders into fewer files
  daily-targets  --active P --bronze B --day D --out O       active ids not fetched that day
  full-targets   --applist A --bronze B --out O [--registry R]  app-list ids never fetched
  register-ids   --bronze B --registry R --start D --end D   add newly landed ids to the registry
  growth    --gold G --out O --start D --end D     materialized growth: advance, or rebuild on late data
  views     --gold G --sql "SELECT ..."                      run SQL over the three gold views
  compact-dim --gold G                                       keep only each game's newest dim version
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys

from playlake.functions.parse import to_date_param


def _day(value: str | None) -> _dt.date:
    # an empty day parameter means the run date.
    return to_date_param(value, default=_dt.date.today())


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="playlake", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("task")
    for opt in ("bronze", "silver", "gold", "active", "applist", "out", "registry", "sql"):
        p.add_argument(f"--{opt}")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--day")
    p.add_argument("--append", action="store_true")
    p.add_argument("--file-bytes", type=int, default=128 * 1024 * 1024)
    p.add_argument("--profile", default="cluster", choices=("cluster", "local"))
    a = p.parse_args(argv)

    from playlake.session import build_session, clear_scratch, scratch_mark

    spark, mark = build_session(profile=a.profile), scratch_mark()
    if a.task in ("silver", "gold", "backfill", "compact", "register-ids", "growth") and not (a.start and a.end):
        p.error("--start and --end are both required (T25)")
    result: object
    if a.task == "silver":
        from playlake.plans.medallion import load_silver

        result = load_silver(spark, a.bronze, a.silver, _day(a.start), _day(a.end))
    elif a.task == "gold":
        from playlake.plans.medallion import load_gold

        result = load_gold(spark, a.silver, a.gold, _day(a.start), _day(a.end),
                           fact_mode="append" if a.append else "replace_date")
    elif a.task == "backfill":
        from playlake.plans.medallion import run_range

        report = run_range(spark, a.bronze, a.silver, a.gold, _day(a.start), _day(a.end))
        result = [r.asDict() for r in report.orderBy("snapshot_date").collect()]  # one row per day
    elif a.task == "compact":
        from playlake.sources.bronze import compact_bronze

        result = compact_bronze(spark, a.bronze, _day(a.start), _day(a.end), a.file_bytes)
    elif a.task == "daily-targets":
        from playlake.operators.targets import daily_targets
        from playlake.sources.bronze import read_active_ids, read_bronze_day

        targets = daily_targets(read_active_ids(spark, a.active),
                                read_bronze_day(spark, a.bronze, _day(a.day), schema="appid bigint"))
        targets.write.mode("overwrite").parquet(a.out)
        result = {"out": a.out}
    elif a.task == "full-targets":
        from playlake.operators.targets import full_load_targets
        from playlake.sources.bronze import known_ids, read_applist

        targets = full_load_targets(read_applist(spark, a.applist), known_ids(spark, a.bronze, a.registry))
        targets.write.mode("overwrite").parquet(a.out)
        result = {"out": a.out}
    elif a.task == "register-ids":
        from playlake.sources.bronze import update_id_registry

        update_id_registry(spark, a.bronze, a.registry, _day(a.start), _day(a.end))
        result = {"registry": a.registry}
    elif a.task == "growth":
        from playlake.plans.medallion import maintain_growth
        from playlake.sources.lake import FACT_TABLE, table_path

        how = maintain_growth(spark, table_path(a.gold, FACT_TABLE), a.out, _day(a.start), _day(a.end))
        result = {"out": a.out, "growth": how}
    elif a.task == "compact-dim":
        from playlake.sources.lake import DIM_TABLE, compact_dim_log, table_path

        result = {"versions_kept": compact_dim_log(spark, table_path(a.gold, DIM_TABLE))}
    elif a.task == "views":
        from playlake.plans.medallion import register_views

        register_views(spark, a.gold)
        spark.sql(a.sql).show(truncate=False)
        result = None
    else:
        p.error(f"unknown task {a.task!r}")
    clear_scratch(spark, mark)
    if result is not None:
        print(json.dumps(result, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
