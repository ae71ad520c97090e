"""Session defaults and shared scratch locations."""

from __future__ import annotations

import os
import re
import threading
import uuid

from pyspark.sql import SparkSession

# Settings every job in the package assumes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "snappy",
    # Broadcast only sides whose size is known to be small: 10 MB by the planner's
    # estimate, which scales compressed file bytes by 3 so a parquet dim is not taken
    # for a third of its in-memory size. AQE re-checks shuffled sides at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "3.0",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Sizing for a large cluster over ~100 TB of input (``build_session(profile="cluster")``).
# Shuffles start wide and AQE merges them to ~256 MB partitions, splitting skewed ones;
# parquet scans split at 512 MB. Gzip JSON is not splittable, so bronze parallelism comes
# from its many small files (<= 1,000 records each), not from split size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.files.openCostInBytes": str(8 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "playlake",
    extra: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests; on a
    cluster leave them ``None`` and pass ``profile="cluster"`` for the sizing above
    (submit-time settings given in ``extra`` still win).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for scratch tables: the one the cluster names in ``spark.checkpoint.dir``.

    A session that names none gets a folder beside its tables, in the warehouse, if that is in a
    shared store or the session runs on one machine. Otherwise an error is raised, as each
    executor would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    beside = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not re.match(r"(?!file:)\w+:", beside) and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{beside}/_scratch"


class _Scratch(threading.local):
    """Scratch paths a thread has handed out and not cleared: a run clears its own, never another's."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_scratch = _Scratch()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    path = f"{checkpoint_root(spark)}/playlake/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"
    _scratch.paths.append(path)
    return path


def scratch_mark() -> int:
    """A place in the thread's list of scratch paths, for ``clear_scratch``."""
    return len(_scratch.paths)


def clear_scratch(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> None:
    """Delete what was written to the scratch paths this thread got after ``since``, but for ``keep``.

    Results may still read their scratch tables, so this is for jobs that have written or
    consumed theirs.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in _scratch.paths[since:] if p not in keep]:
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(conf).delete(jpath, True)
        _scratch.paths.remove(path)
