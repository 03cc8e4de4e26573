"""Session settings and the shared work folder.

Jobs never build their own session: they take the caller's ``SparkSession``.
``build_session`` is for tests, the bench and local runs. On a cluster the
settings below belong in the cluster's defaults instead.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans are designed for. Results do not depend on them (the jobs
# give the same rows in a plain session); they decide how skew is split and
# how much is merged before shuffles. AQE and its skew-join split are on by
# default in Spark 4; they are listed so a cluster profile cannot silently drop
# them. The session time zone does not affect batch jobs (all diary times are
# TIMESTAMP_NTZ); streaming jobs convert explicitly and do not depend on it.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when an operator above it relied on the join's
    # partitioning (worker load aggregates right after lines x visits); AQE
    # then adds a shuffle of the already reduced rows instead of leaving one
    # task with a hot key's rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Let AQE replace a sort-merge join by a shuffled hash join when every
    # build-side partition is measured under this size: no sort of either
    # side, and a hash table that is known to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # Stream state (ids seen, open episodes) off the heap, on local disk with
    # its changes in the checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "carebook", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session for tests and benchmarks."""
    master = master or os.environ.get("CAREBOOK_MASTER", "local[8]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CAREBOOK_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name storage every executor and the driver
    can reach; jobs write their outputs and stream checkpoints below it. Only a
    local-mode session without the setting gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
            "spark.checkpoint.dir", None)
        if root:
            sc.setCheckpointDir(root)
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder "
                "(HDFS, object store) before running carebook jobs on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="carebook-ckpt-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused path under the shared folder (created by the writer)."""
    return f"{checkpoint_root(spark)}/{purpose}-{uuid.uuid4().hex}"
