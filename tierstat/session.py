"""Session helpers: shared checkpoint folder and a local session for tests.

On a cluster the checkpoint folder must be shared storage named by the
cluster in ``spark.checkpoint.dir``; we only read it.  A folder of our own is
set only when none is configured and the master is local (tests, laptops).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def app_id(spark: SparkSession) -> str:
    """The application id (also for sessions without a SparkContext handle)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # e.g. a Spark Connect session
        return spark.conf.get("spark.app.id", "app")


def checkpoint_root(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder, setting one only in local mode."""
    try:
        sc = spark.sparkContext
    except Exception:  # e.g. a Spark Connect session: the server owns the setting
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the server session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder "
            "for checkpoints and written intermediate tables"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tierstat-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tierstat/{name}-{uuid.uuid4().hex[:12]}"


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, extra: dict[str, str] | None = None
) -> SparkSession:
    """A local session configured like the tests and the bench (``extra``: more settings)."""
    builder = SparkSession.builder
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cores}]")
        .appName("tierstat")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Session settings sized for a run over ``input_bytes`` of Parquet on ``total_cores`` cores.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input (at least three waves of tasks), so a partition of the largest
    shuffle (the per-order line aggregate) fits in task memory without heavy
    spilling; AQE then coalesces small partitions and splits skewed ones.
    File splits are capped at 256 MiB so scans use every core.
    """
    partitions = max(3 * total_cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # On a shared cluster, coalesce to the advisory size instead of keeping
        # many small tasks for parallelism (Spark's own advice for busy clusters).
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 << 20),
        "spark.sql.shuffle.partitions": str(int(partitions)),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.parquet.filterPushdown": "true",
    }
