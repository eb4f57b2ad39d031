"""Spark session defaults for the engine.

Everything here is plain Spark configuration: UTC session time zone, adaptive
query execution (runtime coalescing, skew-join splitting and runtime
broadcast conversion), and a checkpoint directory taken from the cluster
(``spark.checkpoint.dir``) when one is configured.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Applied only when no master is given (a cluster launch): start with many
# shuffle partitions and let AQE coalesce them to ~256 MB each, read input in
# 256 MB splits, and split skewed join partitions above 512 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "gaugeflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if master is None:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone",):
        spark.conf.set(k, conf[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there and we use it as is. Only when the
    setting is absent do we pick a scratch folder of our own, and only on a
    local master: executors on other machines would not see it.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="gaugeflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
