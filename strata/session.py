"""Session helpers for tests, the bench and scripts.

The library itself never builds or mutates a session: every transform takes the
caller's ``SparkSession``. These helpers exist for entry points only.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a 1000-executor run wants as well: AQE re-plans joins and
# partition counts from runtime sizes and splits skewed join partitions.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata", event_log_dir: str | None = None
) -> SparkSession:
    """A local session for tests and the bench; ``event_log_dir`` keeps a plain-text event log there."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        # local runs only: catalog databases go to a fresh folder, not the working directory
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-warehouse-"))
    )
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    if event_log_dir:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", event_log_dir)
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
        )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is absent, a local-mode session (``local[...]``: driver and executors are
    one process on one machine) gets a temp folder of its own; any other session raises, since
    executors would write to disks that the others cannot read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint dir (never machine-local on a cluster)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/strata-{name}-{uuid.uuid4().hex[:12]}"
