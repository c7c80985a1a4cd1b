"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cohortkit") -> SparkSession:
    """Session with the settings the operators are designed for.

    On a cluster ``master`` is left to spark-submit; the shuffle partition
    count should then be sized so one partition holds ~128-256 MB.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", os.environ.get("COHORTKIT_DRIVER_MEMORY", "16g"))
    b = (b.config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.adaptive.localShuffleReader.enabled", "true")
          .config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.sources.partitionOverwriteMode", "dynamic"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A local master without the setting gets a scratch folder; on a cluster its
    absence is an error, since executors share no local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        d = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
