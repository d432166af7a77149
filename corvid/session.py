"""Session helpers.

Library code never creates a session; it takes the caller's.  ``local_session``
exists for tests and the benchmark only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corvid") -> SparkSession:
    """A local session for tests / bench: AQE on, UI off, UTC clock."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CORVID_DRIVER_MEMORY", "16g"))
    )
    event_log = os.environ.get("CORVID_EVENT_LOG_DIR")
    if event_log:  # stage / task timings without the UI: Spark's event log in a scratch folder
        os.makedirs(event_log, exist_ok=True)
        builder = (builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log)
                   .config("spark.eventLog.compress", "false"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, setting one only where none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    if it is unset there, this raises.  Only a local session without one (tests)
    gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage; "
                               "a machine-local folder does not survive lost executors")
        configured = tempfile.mkdtemp(prefix="corvid-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that this library wrote, on whatever file system it lies."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
