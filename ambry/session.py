"""Spark session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on.  Time zone is pinned so that the few
# TIMESTAMP (LTZ) values we emit render identically everywhere; the data
# itself is TIMESTAMP_NTZ and time-zone independent.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Starting point for a large cluster (~1000 executors, ~100 TB inputs): many
# initial shuffle partitions that AQE coalesces to ~256 MB each, larger scan
# splits, and skew splitting for joins.  Tune per workload.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(master: str | None = None, app: str = "ambry",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the jobs expect.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK_DIRS: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``, or the user with
    ``setCheckpointDir``.  Only local sessions without either get a folder of
    their own, once per SparkContext; a cluster without one is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not d:
        d = _FALLBACK_DIRS.get(id(sc))
        if d is None:
            d = tempfile.mkdtemp(prefix="ambry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
            _FALLBACK_DIRS[id(sc)] = d
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
