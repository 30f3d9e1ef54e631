"""Session defaults and the shared scratch location.

Cluster settings win: every default here is applied only when the key is
not already set, so a cluster's own `spark-defaults.conf` stays in charge.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for correctness (UTC, ANSI left on) and for scale (AQE
# re-plans joins from real shuffle sizes, splits skewed partitions and
# coalesces small ones).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
# Always: no web UI server, no console progress bars.
FIXED_CONF = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_spark(app_name: str = "jobtide", master: str | None = None,
              extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one; `extra_conf` always applies,
    DEFAULT_CONF only for keys the cluster configuration does not set."""
    extra_conf = dict(extra_conf or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**FIXED_CONF, **extra_conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    cluster = spark.sparkContext.getConf()
    for key, value in DEFAULT_CONF.items():
        if key not in extra_conf and not cluster.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder on shared storage for checkpoints, stream state and staged tables.

    Reads `spark.checkpoint.dir` (or the context's checkpoint dir). Where neither
    is set, a local master gets a fresh temporary folder, registered as the
    checkpoint dir; on a cluster that is an error, as each executor would write
    to a disk of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="jobtide-")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new, unique sub-folder of the shared dir for one run of `name`."""
    base = shared_dir(spark)
    sub = f"{name}-{uuid.uuid4().hex[:12]}"
    return f"{base}/{sub}"
