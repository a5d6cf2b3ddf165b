"""Session settings the model relies on.

Correctness never depends on these (every query states its own null ordering, casts
and tiebreaks); they only shape the physical plan.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the warehouse is tuned for.  AQE re-plans joins at runtime (broadcast
# conversion when a shuffled side turns out small, skew-partition splitting,
# partition coalescing), so no join below carries a size-unchecked broadcast hint.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for the 100 TB / ~1000-executor deployment.  Initial shuffle partitions are
# sized for ~200 MB per partition at the largest shuffle (the player fact's game-keyed
# join, roughly a fifth of raw box-score bytes after projection); AQE coalesces small
# stages back down and splits skewed partitions above 5x the median and 256 MB.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "courtline", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the warehouse defaults.

    ``master`` is only set when given, so on a cluster the launcher's master wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# For tables that lie in buckets of the game: a join on game and team keeps to the buckets, and a write by season
# keeps one file open per season instead of sorting (and spilling) whole tasks.
STORED_CONF = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}


def keep_to_buckets(spark: SparkSession) -> None:
    for k, v in STORED_CONF.items():
        spark.conf.set(k, v)


_LOCAL_CKPT: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    The cluster setting always wins.  Where it is unset a scratch folder is created and registered on a
    local master; on any other this is an error, as executors would write to disks of their own.
    """
    current = (spark.conf.get("spark.checkpoint.dir", None)
               or spark.sparkContext.getConf().get("spark.checkpoint.dir", None))
    if current:
        spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_CKPT:
        _LOCAL_CKPT[key] = tempfile.mkdtemp(prefix="courtline-ckpt-",
                                            dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(_LOCAL_CKPT[key])
        try:
            spark.conf.set("spark.checkpoint.dir", _LOCAL_CKPT[key])
        except Exception:  # noqa: BLE001 - some deployments refuse core confs at runtime
            pass
    return _LOCAL_CKPT[key]
