"""Session helpers: build a local session for tests and resolve the shared
checkpoint folder from the cluster configuration."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on. On a cluster these come from spark-defaults;
# ``local_session`` sets them for tests and the bench.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "lendgrid") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    event_dir = os.environ.get("LENDGRID_EVENT_LOG_DIR")
    if event_dir:  # stage / task times from the event log, no UI server
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only a local-mode session without one (tests,
    the local bench) falls back to a fresh scratch folder; on a cluster a
    machine-local folder would not survive a lost executor, so a missing
    setting is an error."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for checkpoints and slices")
    scratch = tempfile.mkdtemp(prefix="lendgrid-ckpt-")
    spark.sparkContext.setCheckpointDir(scratch)
    return scratch
