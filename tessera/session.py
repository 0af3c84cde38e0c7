"""Session helpers: one place for the Spark settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job here expects. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splits hot partitions; UTC keeps the
# timestamp arithmetic in the telemetry/state folds deterministic.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # filters reach the tasks that list files (sources.listing)
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable checkpoint files once the checkpointed data is released
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are only applied when given, so a
    cluster submit keeps its own values.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "6g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment (a shared file system),
    and it is an error if it isn't; a scratch folder is picked only on a local
    master where nothing is configured, as in tests.
    """
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local
