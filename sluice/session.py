"""Session helpers and the shared scratch/lake location.

On a cluster the session is created by the platform; the library only reads
its settings. ``local_session`` is for tests, the bench and notebooks.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Conf key a deployment may set to pin the lake root explicitly.
LAKE_ROOT_CONF = "spark.sluice.lake.root"
CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "sluice", extra: dict | None = None) -> SparkSession:
    """A local-mode session with the settings our plans assume.

    AQE stays on (runtime coalescing, skew-join splitting, broadcast
    conversion from measured sizes). The UI is off: no port is opened.
    """
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 4 * n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")  # items that load at the same time share the cores
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.sources.partitionOverwriteMode", "static")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root folder for written tables and lineage cuts.

    Order: explicit ``spark.sluice.lake.root``; the cluster's
    ``spark.checkpoint.dir`` (shared storage on a cluster); only when neither
    is set (local tests) a fresh temporary folder, which is then also set as
    the checkpoint dir so ``DataFrame.checkpoint()`` works.
    """
    conf = spark.conf
    root = conf.get(LAKE_ROOT_CONF, None)
    if root:
        return root.rstrip("/")
    ckpt = conf.get(CHECKPOINT_CONF, None)
    if not ckpt:
        ckpt = spark.sparkContext.getCheckpointDir()
    if not ckpt:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder is invisible to other executors and lost
            # with the node: refuse instead of silently using one.
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} (or {LAKE_ROOT_CONF}) to a shared folder; "
                "no local fallback on a cluster")
        ckpt = tempfile.mkdtemp(prefix="sluice-ckpt-")
        spark.sparkContext.setCheckpointDir(ckpt)
        ckpt = spark.sparkContext.getCheckpointDir() or ckpt
    return ckpt.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared root (never reused)."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; returns the directory."""
    root = shared_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{root}/_checkpoints")
    return spark.sparkContext.getCheckpointDir()
