"""Session helpers for local runs (tests, bench).  A cluster job passes its own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app_name: str = "vaultline") -> SparkSession:
    """A local session with adaptive execution on and the web UI off."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (local tests) is ``fallback``
    installed, which must then be given.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set; pass a shared folder as fallback")
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback
