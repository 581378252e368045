"""Session helpers: a tuned local session for tests/bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "metrolens",
                  shuffle_partitions: int | None = None, driver_memory: str | None = None) -> SparkSession:
    """Session with AQE on, UTC clock and the UI off.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle partition count then comes from the cluster config unless given.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Python-side call-site capture costs several JVM round trips per Column call.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:  # only effective before the JVM starts (local mode: the whole heap)
        conf["spark.driver.memory"] = driver_memory
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests) gets a private folder; on
    a cluster a machine-local folder would not survive a lost executor, so
    the setting is required there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="metrolens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"scratch-{name}-{uuid.uuid4().hex[:12]}")
