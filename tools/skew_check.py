"""Measure what crosses the shuffle when one key holds a third of all rows.

Usage: python tools/skew_check.py [rows] > docs/SKEW_CHECK.md
Runs each skew-prone operator on data where one key holds a third of the rows,
with Spark's event log written to a fresh scratch folder, then reads the log:
per stage, the total records written to the shuffle and the largest number of
records any single task read from it. No Spark UI or REST endpoint is used.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 600_000
    log_dir = tempfile.mkdtemp(prefix="playlake-eventlog-")
    from pyspark.sql import functions as F

    from playlake.operators.gold import latest_dim
    from playlake.operators.growth import genre_growth
    from playlake.operators.targets import full_load_targets
    from playlake.operators.silver import company_bridge, dedup_snapshots
    from playlake.session import build_session, scratch_path
    from playlake.sources.bronze import write_bronze

    spark = build_session("local[8]", 16, app_name="skew-check", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        # small target partitions so AQE's skew handling is visible at laptop scale
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    })
    hot = F.col("id") % 3 == 0  # every third row belongs to the hot key
    base = spark.range(n).repartition(16)
    rows = base.select(
        F.when(hot, F.lit(1)).otherwise(F.col("id")).cast("bigint").alias("appid"),
        F.when(hot, F.lit(dt.date(2024, 1, 5))).otherwise(
            F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 30).cast("int"))).alias("snapshot_date"),
        F.expr("timestampadd(SECOND, id, timestamp_ntz'2024-01-01 00:00:00')").alias("fetched_at"),
        F.array(F.when(hot, F.lit("HotStudio")).otherwise(F.concat(F.lit("s"), (F.col("id") % 1000).cast("string")))
                ).alias("developers"),
        F.array().cast("array<string>").alias("publishers"),
        F.lit(True).alias("success"),
    ).cache()
    rows.count()
    jobs = []

    def run(label, df_or_fn):
        spark.sparkContext.setJobGroup(label, label)
        if callable(df_or_fn):
            df_or_fn()
        else:
            df_or_fn.write.format("noop").mode("overwrite").save()
        jobs.append(label)

    run("dedup: one (appid, day) holds 1/3 of rows", dedup_snapshots(rows.select("appid", "snapshot_date", "fetched_at")))
    run("company bridge distinct: one company in 1/3 of rows", company_bridge(rows))
    growth = rows.select("snapshot_date", "appid", F.lit(1).cast("bigint").alias("recommendations_total"),
                         F.lit(1).cast("bigint").alias("rec_growth_1d"), F.lit(1).cast("bigint").alias("rec_growth_7d"))
    dim = spark.range(n).select(F.col("id").alias("appid"),
                                F.array(F.when(F.col("id") % 3 == 0, F.lit("Action")).otherwise(
                                    F.concat(F.lit("g"), (F.col("id") % 500).cast("string")))).alias("genres"))
    run("genre growth: one genre in 1/3 of games", genre_growth(growth.dropDuplicates(["appid", "snapshot_date"]), dim))
    empty = F.array().cast("array<string>")
    versions = rows.select(
        "appid", F.lit("n").alias("name"), F.lit("game").alias("type"), F.lit(None).cast("date").alias("release_date"),
        F.lit(0).cast("smallint").alias("required_age"), F.lit(0).cast("smallint").alias("coming_soon"),
        empty.alias("genres"), empty.alias("categories"), empty.alias("developers"), empty.alias("publishers"),
        F.col("fetched_at").alias("updated_at"), F.lit(1).cast("bigint").alias("load_seq"))
    run("latest dim: one game holds 1/3 of all versions", latest_dim(versions))
    app_list = base.select(F.when(hot, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("appid"))
    known = spark.range(0, n, 2).select(F.col("id").alias("appid"))
    run("full-load targets: 1/3 of the app list lacks an id (-> 0)", full_load_targets(app_list, known))
    out = scratch_path(spark, "skew_bronze")
    bronze = rows.select("appid", "success", F.col("fetched_at").cast("string").alias("fetched_at"), "snapshot_date")
    run("bronze write: one day holds 1/3 of rows", lambda: write_bronze(bronze, out, rows_per_file=1000))
    spark.stop()

    events = []
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            events += [json.loads(line) for line in fh]
    group_of_job, stage_job = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            group = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_job[sid] = group
    stats: dict = {}
    for e in events:
        if e["Event"] != "SparkListenerTaskEnd" or "Task Metrics" not in e:
            continue
        group = stage_job.get(e["Stage ID"])
        if group not in jobs:
            continue
        m = e["Task Metrics"]
        read = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
        wrote = m.get("Shuffle Write Metrics", {}).get("Shuffle Records Written", 0)
        out_rows = m.get("Output Metrics", {}).get("Records Written", 0)
        s = stats.setdefault((group, e["Stage ID"]), {"tasks": 0, "read": 0, "max_read": 0, "wrote": 0, "max_out": 0})
        s["tasks"] += 1
        s["read"] += read
        s["max_read"] = max(s["max_read"], read)
        s["wrote"] += wrote
        s["max_out"] = max(s["max_out"], out_rows)
    print(f"# Skew check ({n:,} input rows, hot key = 1/3 of rows = {n // 3:,})\n")
    print("Generated by `tools/skew_check.py` from Spark's event log (local[8], 16 shuffle partitions, "
          "AQE with 1 MB target partitions so its skew handling shows at this size). One row per stage; "
          "stages that only read the cached input and wrote nothing are left out.\n")
    print("| operator | stage | tasks | records read from shuffle | max read by one task | records written to shuffle | max rows one task wrote to files |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for label in jobs:
        for (group, stage), s in sorted(stats.items(), key=lambda kv: kv[0][1]):
            if group != label or not (s["read"] or s["wrote"] or s["max_out"]):
                continue
            print(f"| {label} | {stage} | {s['tasks']} | {s['read']:,} | {s['max_read']:,} | {s['wrote']:,} | {s['max_out']:,} |")


if __name__ == "__main__":
    main()
