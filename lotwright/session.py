"""Session construction and cluster-facing settings.

Library code never builds its own session; it receives one.  ``get_session``
is for tests, ``bench.py`` and scripts.  ``checkpoint_dir`` reads the shared
folder the cluster names in ``spark.checkpoint.dir``; a fresh local scratch
folder takes its place only when the master is local and the setting is absent.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library expects.  On a cluster the same keys
# are given by the job submission; the values here are the local defaults.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ui.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Path tables (parquet.`/x`) would bypass the guarded query surface.
    "spark.sql.runSQLOnFiles": "false",
    # Whole-stage methods over wide rows (35 gold columns plus regex-heavy
    # parsing) exceed HotSpot's 8000-bytecode JIT limit and would run
    # interpreted; let the JIT compile them.  Measured ~2.5x on the gold
    # projection.  On a cluster the same option goes to the executors.
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "lotwright", extra: dict | None = None) -> SparkSession:
    master = master or os.environ.get("LOTWRIGHT_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app_name)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("LOTWRIGHT_DRIVER_MEMORY", "8g")))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a local one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="lotwright-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint root for written intermediate tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tables/{name}"
