"""Session settings the warehouse relies on.

The warehouse never builds its own cluster: jobs receive a SparkSession.
``configure`` sets only the SQL options that the semantics depend on
(UTC session zone, ANSI arithmetic, AQE).  ``local_session`` is a helper
for tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Options whose values the results depend on (UTC: timestamps are zone-less
# wall-clock values; ANSI: strict casts raise instead of silently nulling).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Options that only change the physical plan.
PLANNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # spread a shuffle over all cores down to 1 MB a task: the advisory size is of compressed bytes, and a task of
    # keys that compress well holds ten times as much in memory
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession, extra: dict[str, str] | None = None) -> SparkSession:
    """Apply the semantic and planning options (plus ``extra``, e.g. from
    ``scale_conf``) to a running session."""
    for key, value in {**SEMANTIC_CONF, **PLANNING_CONF, **(extra or {})}.items():
        spark.conf.set(key, value)
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle/scan sizing for a given raw input volume and cluster size.

    Start shuffles with enough partitions that none exceeds ~256 MB even
    before map-side combining (AQE then coalesces small ones), never fewer
    than 3 waves of tasks; split scans at 256 MB.  For 100 TB on 1000
    executors x 8 cores this gives ~400k initial shuffle partitions,
    coalesced at runtime to the advisory size."""
    partitions = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def input_bytes(spark: SparkSession, paths: list[str]) -> int | None:
    """Total size of files under ``paths`` via each path's Hadoop
    filesystem (None when the JVM is not reachable, e.g. Spark Connect)."""
    try:
        sc = spark.sparkContext
        jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    except Exception:  # Spark Connect: no JVM handle on the client
        return None
    total = 0
    for p in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(p)
        total += int(hpath.getFileSystem(conf).getContentSummary(hpath).getLength())
    return total


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    value = spark.sparkContext.getCheckpointDir()
    if value:
        return value
    value = spark.conf.get("spark.checkpoint.dir", None)
    return value or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a private one only when
    the session has none AND runs in local mode (tests, benchmarks).  On a
    cluster a machine-local folder would be wrong, so that is an error."""
    existing = checkpoint_dir(spark)
    if existing:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(existing)
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="parcelworks-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "parcelworks") -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, UTC, AQE)."""
    n = (os.cpu_count() or 8) if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PARCELWORKS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", os.environ.get("PARCELWORKS_ADVISORY_PARTITION", "8m"))
    )
    event_dir = os.environ.get("PARCELWORKS_EVENT_LOG_DIR")
    if event_dir:  # stage/task timings for offline inspection
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    for key, value in {**SEMANTIC_CONF, **PLANNING_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark
