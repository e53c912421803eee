"""Session construction and the few session-level settings we rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every tidemark job wants. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is below the threshold), coalesces
# small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast is decided from size statistics, never forced on a side
    # whose size grows with the data.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # target size of post-shuffle partitions; AQE coalesces small ones and
    # splits skewed ones against it
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Return a session with tidemark's defaults.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster the submitter sets them.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "8g"))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in
    ``spark.checkpoint.dir``. Only a local-mode session (tests, local runs)
    with the setting unset gets a scratch folder of its own; on a cluster an
    unset setting is an error, never a machine-local folder."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master or ""
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this "
                               "cluster; tidemark writes checkpoints and derived tables there")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
