"""Session helpers: a local session for tests and the bench, and the shared
folder for checkpoints and intermediate tables.

The folder comes from ``spark.checkpoint.dir`` as the cluster sets it.  A
local session made here sets one of its own where none is set.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "abiflow") -> SparkSession:
    builder = SparkSession.builder
    if not SparkConf().contains(CHECKPOINT_CONF):
        builder = builder.config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="abiflow-ckpt-"))
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, also made the SparkContext's
    (``checkpoint()``); an error if the session has none."""
    sc = spark.sparkContext
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if not path:
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder for written intermediate tables."""
    return os.path.join(shared_dir(spark), *parts)
