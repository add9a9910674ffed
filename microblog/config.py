"""Session defaults and the shared scratch location.

Jobs never write to a machine-local temporary folder on a cluster: every
intermediate table, replay directory and streaming checkpoint lives under the
shared folder the cluster names in ``spark.checkpoint.dir``. Only when that is
unset (unit tests, a laptop) do we pick a local folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def session_defaults(cpus: int = 8, shuffle_partitions: int | None = None) -> dict[str, str]:
    """Config for local runs (tests, bench). A cluster passes its own."""
    parts = shuffle_partitions or cpus
    return {
        "spark.master": f"local[{cpus}]",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.default.parallelism": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.schemaInference": "false",
    }


def cluster_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20,
                     broadcast_bytes: int = 64 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized from the input volume.

    Scan splits and shuffle partitions target ``partition_bytes`` each (so a
    task's working set fits executor memory and spills rarely), rounded up to
    whole waves of ``total_cores``; AQE coalesces small shuffle partitions and
    splits skewed ones at runtime. For 100 TB on 1 000 executors × 8 cores this
    gives 376 000 shuffle partitions (47 waves of 8 000 tasks).
    """
    waves = -(-input_bytes // (partition_bytes * total_cores))  # ceil
    partitions = max(total_cores, waves * total_cores)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.session.timeZone": "UTC",
    }


def local_session(app: str = "microblog", cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in session_defaults(cpus, shuffle_partitions).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only if none is set."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the server owns the setting
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="microblog-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/microblog/{name}-{uuid.uuid4().hex[:12]}"


# Executor and worker both hold the batches that a task gets; a session that has a
# size of its own keeps it.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 8 << 20


def ship_package(spark: SparkSession) -> None:
    """Workers find this package where it lies (on a cluster it is installed or
    sent as a py-file), and get their rows in batches of a bounded size."""
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(ARROW_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)
