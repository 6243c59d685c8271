"""Session helpers: shared work folders and a local session for tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Streaming checkpoints, changelogs and sink tables of this package live
    under it. Only when the session names none (a local test session) is a
    fresh temporary folder created and registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sensorwatch-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the checkpoint root for one run of a named job."""
    return f"{checkpoint_root(spark)}/sensorwatch/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cores: str | int = "*", app: str = "sensorwatch", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session with the settings the tests and the bench use (UTC, AQE on, no UI)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
