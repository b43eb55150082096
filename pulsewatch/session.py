"""Session construction and shared scratch locations.

Every job pins the session time zone to UTC: the wire format carries event
time as zone-less text, and the stored tables compare it with UTC bounds.

Broadcasts: the static planner would broadcast a join side whose *estimated*
size is small; estimates are not a bound (a generator or a skewed key can
grow a side past them). So static broadcasting is off, and AQE broadcasts a
side only after its shuffle stage has run and its measured size is under the
threshold.

Scratch output (archives written and read back, keyed tables of a test run,
stream checkpoints, stage results) lives under the shared folder the cluster
names in ``spark.checkpoint.dir``. Only a local master, whose tasks share the
driver's disk, gets a default; elsewhere the setting is required. Each application writes below its own
folder, which :func:`drop_scratch` deletes once its results are consumed.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

DEFAULT_LOCAL_CHECKPOINT_DIR = "/tmp/pulsewatch-checkpoints"

# Broadcast only sides measured at runtime (AQE), never on estimates.
BROADCAST_POLICY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def cluster_settings(input_bytes: int, total_cores: int,
                     split_bytes: int = 512 << 20, shuffle_bytes: int = 2 << 30) -> dict[str, str]:
    """Sizes for a job reading ``input_bytes`` on ``total_cores`` cores.

    The driver tracks one entry per map task and shuffle partition, so both
    numbers are kept down: scans split at ``split_bytes`` and a shuffle
    starts with one partition per ``shuffle_bytes`` of input, at least three waves of tasks. Sorts and
    aggregates of such a partition spill to local disk; AQE coalesces what
    turns out small and splits skewed partitions. Example: 100 TB on 1000
    executors x 8 cores reads in about 200,000 tasks and shuffles into about 50,000
    partitions.
    """
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(max(3 * total_cores, -(-input_bytes // shuffle_bytes))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * shuffle_bytes),
    }


def build_session(
    master: str | None = None,
    app_name: str = "pulsewatch",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the settings every job relies on.

    For a cluster run pass ``extra=cluster_settings(input_bytes, cores)``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **BROADCAST_POLICY,
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_policy(spark)
    expose_package(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_policy(spark: SparkSession) -> None:
    """The one setting every plan here relies on: event time is compared in UTC.

    Broadcast settings of a session made elsewhere stay as they are.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def expose_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package.

    Only for a local master, where workers see the driver's files; on a
    cluster ship the package with ``--py-files`` or install it.
    """
    try:
        context = spark.sparkContext
        local = context.master.startswith("local")
    except Exception:  # noqa: BLE001 - remote session: the server owns its workers
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [p for p in context.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if local and root not in paths:
        context.environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def default_parallelism(spark: SparkSession) -> int:
    """Cores available to a job (falls back to the shuffle partition count
    where no SparkContext is reachable, e.g. a remote session)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote sessions have no SparkContext
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; only a local master gets a default."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        context = spark.sparkContext
        current = context.getCheckpointDir()
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return configured
    if current:
        # getCheckpointDir adds a per-application child folder.
        return configured or os.path.dirname(current.rstrip("/"))
    if not configured and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    base = configured or DEFAULT_LOCAL_CHECKPOINT_DIR
    context.setCheckpointDir(base)
    return base


def _scratch_root(spark: SparkSession) -> str:
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote session
        app = "remote"
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pulsewatch/{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folders; call it after the last result is consumed."""
    delete_folders(spark, [_scratch_root(spark)])


def delete_folders(spark: SparkSession, paths: Sequence[str]) -> None:
    """Remove folders through the file system that Spark uses."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
