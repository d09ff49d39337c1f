"""SparkSession construction and the shared working folder.

Intermediate tables (staged slices, merge targets built for a query, CSV
round trips) are written below the folder the cluster names in
``spark.checkpoint.dir``.  That folder is expected to be on shared storage
(HDFS, S3, GCS ...), so a lost executor never takes written data with it.
Only when the setting is absent *and* Spark runs in local mode (tests, the
bench) do we pick a folder of our own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Session settings every job of the warehouse relies on.
BASE_CONF: dict[str, str] = {
    # DATE(ts) / month truncation must not depend on the JVM's zone.
    "spark.sql.session.timeZone": "UTC",
    # Strict casts raise, try_* variants give NULL (ingest vs. extract).
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn joins with a measured-small side into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Broadcast only what was measured: no broadcast from static size
    # estimates (a projected fact scan can look small, and a join's output
    # estimate is a product of guesses); AQE converts a join to a broadcast
    # when a side's *shuffled* size, measured at runtime, is small, and
    # operators hint broadcasts behind measured sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # A skewed join is split even where that costs one more exchange (a hot
    # order between two joins that share a partitioning).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rewrite a partitioned target's scan to the partitions a join needs.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Listing a day-partitioned table: one listing task per ~tens of day
    # folders, not one per folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


#: Extra settings for local mode only (tests, the bench): no web page.
LOCAL_CONF: dict[str, str] = {"spark.ui.enabled": "false"}


def build_session(
    master: str | None = "local[*]",
    app_name: str = "emporia",
    shuffle_partitions: int | None = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    On a cluster pass ``master=None`` and size ``shuffle_partitions`` so a
    partition holds roughly 128-256 MB of shuffled data (AQE coalesces
    downwards from there).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        conf.update(LOCAL_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _configured_dir(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found:
        return found
    found = sc.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:  # not set
        return None


def work_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Read from the session (``spark.checkpoint.dir``).  A folder of our own
    is chosen only for local-mode sessions where nothing is configured.
    """
    found = _configured_dir(spark)
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(hdfs://, s3a://, gs://) before running warehouse jobs"
        )
    local = tempfile.mkdtemp(prefix="emporia-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return (spark.sparkContext.getCheckpointDir() or local).rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder below :func:`work_dir`."""
    return f"{work_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
