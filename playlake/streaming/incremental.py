"""Process whatever bronze landed since the last run: silver, then gold, for those days.

The reference chains "fetch -> combine -> transform that day" through scheduler
triggers. Here a file-source stream over the bronze root plays the trigger: its
checkpoint records which files were already processed (so a restart neither skips
nor repeats work), and exactly the touched days are rebuilt from
their whole day folders. Rebuilding whole days keeps the result correct when late
files arrive for a day already processed (the dedup sees every file of the day) and
makes a retried batch write the same rows again (replace-date everywhere). With ``merge`` the new files alone
are parsed and merged into the rows kept so far, to the same result. Files a compaction has
written are known by their names and touch no day.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlake.plans.medallion import load_gold, load_silver, maintain_growth, merge_silver
from playlake.sources.lake import FACT_TABLE, _delete_path, _glob, table_path
from playlake.schemas import BRONZE_DDL
from playlake.session import checkpoint_root
from playlake.sources.bronze import LANDED_GLOB
from playlake.sources.paths import day_runs


def _touched(batch: DataFrame) -> DataFrame:
    day = F.make_date(F.col("year"), F.col("month"), F.col("day")).alias("d")
    return batch.select(day).where("d is not null").distinct()


def _days(touched: DataFrame) -> list:
    # One value per calendar day: bounded by the calendar.
    return sorted(r.d for r in touched.distinct().collect())


def _landed_files(spark: SparkSession, bronze_root: str, max_files_per_trigger: int, merge: bool) -> DataFrame:
    files = (
        spark.readStream.schema(BRONZE_DDL + ", year int, month int, day int")
        .option("basePath", bronze_root)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("pathGlobFilter", LANDED_GLOB)  # compacted files bring nothing new
        .json(bronze_root)
    )
    if merge:
        return files.withColumn("snapshot_date", F.make_date("year", "month", "day"))
    return files.select("year", "month", "day")


def _checkpoint(spark: SparkSession, checkpoint: str | None, *roots: str | None) -> str:
    key = hashlib.sha1("|".join(map(str, roots)).encode()).hexdigest()[:16]
    return checkpoint or f"{checkpoint_root(spark)}/playlake/streams/medallion-{key}"


def _rebuild(spark, days, bronze_root, silver_root, gold_root, growth_root, updated_at, merged: bool) -> None:
    """The touched days' silver (unless merged already) and gold, then growth once over all of them."""
    for start, end in day_runs(days):
        if not merged:
            load_silver(spark, bronze_root, silver_root, start, end)
        if gold_root:
            load_gold(spark, silver_root, gold_root, start, end, updated_at=updated_at)
    if days and gold_root and growth_root:
        maintain_growth(spark, table_path(gold_root, FACT_TABLE), growth_root, days[0], days[-1])


def drain_incremental_load(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int = 1000,
    updated_at=None,
    growth_root: str | None = None,
    merge: bool = False,
) -> list:
    """Take in everything that has landed since the last call, and return the days rebuilt.

    The stream's micro-batches only note the days their files belong to. When it has drained,
    each touched day is rebuilt once, and growth advanced or rebuilt once, however many
    batches a day was spread over. The notes are removed last, so a run that died is
    made up for by the next. ``checkpoint`` must be a stable folder per pair of roots; by default it
    lives under the session's shared checkpoint folder. With ``merge`` each micro-batch's files are merged
    into silver as they are taken in (``merge_silver``), and only gold waits for the end.
    """
    ckpt = _checkpoint(spark, checkpoint, bronze_root, silver_root, gold_root)
    notes = f"{ckpt}/touched-days"

    def note(batch: DataFrame, batch_id: int) -> None:
        if merge:
            merge_silver(spark, batch, bronze_root, silver_root)
        _touched(batch).write.mode("overwrite").parquet(f"{notes}/batch-{batch_id}")

    files = _landed_files(spark, bronze_root, max_files_per_trigger, merge)
    writer = files.writeStream.foreachBatch(note).option("checkpointLocation", f"{ckpt}/stream")
    writer.trigger(availableNow=True).start().awaitTermination()
    noted = [p.rsplit("/", 1)[0] for p in _glob(spark, f"{notes}/batch-*/_SUCCESS")]
    days = _days(spark.read.schema("d date").parquet(*noted)) if noted else []
    _rebuild(spark, days, bronze_root, silver_root, gold_root, growth_root, updated_at, merge)
    _delete_path(spark, notes)
    return days


def start_incremental_load(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    gold_root: str | None = None,
    checkpoint: str | None = None,
    every: str = "1 minute",
    max_files_per_trigger: int = 1000,
    updated_at=None,
    growth_root: str | None = None,
    merge: bool = False,
) -> StreamingQuery:
    """Start a stream that rebuilds the days each micro-batch touches, until it is stopped.

    For scheduled runs ``drain_incremental_load`` does less work. Growth is maintained once per
    micro-batch: advanced for new days, repaired when late data reaches back. ``merge`` as there.
    """
    ckpt = _checkpoint(spark, checkpoint, bronze_root, silver_root, gold_root)

    def process(batch: DataFrame, batch_id: int) -> None:
        if merge:
            merge_silver(spark, batch, bronze_root, silver_root)
        _rebuild(spark, _days(_touched(batch)), bronze_root, silver_root, gold_root, growth_root, updated_at, merge)

    files = _landed_files(spark, bronze_root, max_files_per_trigger, merge)
    writer = files.writeStream.foreachBatch(process).option("checkpointLocation", f"{ckpt}/stream")
    return writer.trigger(processingTime=every).start()
