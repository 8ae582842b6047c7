"""Session helpers: a tuned local session for tests/bench, checkpoint dir lookup."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "noticeflow") -> SparkSession:
    """Session with the settings the library is designed for.

    On a cluster the same keys come from spark-defaults; only the values for
    ``master`` and the shuffle partition count differ.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("NOTICEFLOW_DRIVER_MEM", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, honouring ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage named by the cluster's
    ``spark.checkpoint.dir``; we only create a private folder when nothing is
    configured (local tests and the bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="noticeflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder.

    Used where a plan would otherwise recompute an expensive upstream (page
    parsing) for several consumers; survives executor loss, unlike caching.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
