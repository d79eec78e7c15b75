"""Session helpers shared by tests, the bench and the examples.

A cluster passes its own settings; ``local_session`` only fills what is unset, so the same code runs
under ``spark-submit`` on a cluster and in a local test.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kinfold") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("KINFOLD_DRIVER_MEMORY", "16g"))
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a scratch one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as it is. Only a local
    session without that setting (tests) gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="kinfold-ckpt-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` into the session's checkpoint folder (eager).

    Used where one intermediate feeds several branches of a plan: they then read the written copy
    instead of each recomputing it, and the copy survives the loss of executors (unlike a local
    checkpoint or a cache).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
