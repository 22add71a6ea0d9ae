"""Session helpers: local sessions for tests, checkpoint folders, table loading."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "sheen",
                  extra: dict | None = None) -> SparkSession:
    """A local session configured the way tests and the bench run.

    A checkpoint folder is set only because none is configured here; on a
    cluster ``spark.checkpoint.dir`` comes from the cluster configuration.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="sheen-warehouse-"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    Order: the folder already set on the context, then ``spark.checkpoint.dir``
    from the session configuration (the shared folder a cluster names). Only a
    local-mode session with neither gets a private temporary folder; a cluster
    session without one is an error, because a machine-local folder would not
    survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        path = tempfile.mkdtemp(prefix="sheen-ckpt-")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; iterative operators need a shared folder")


def drop_unused_shuffles(spark) -> None:
    """Shuffle files and cached blocks of fits and plans that nothing refers to any more are deleted
    when the driver collects its garbage, which it may not do for half an hour."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
